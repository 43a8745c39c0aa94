from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from loadlens.schema import RAW_SCHEMA  # noqa: E402
from loadlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="loadlens-tests", extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def make_obs(spark):
    """Frame in the raw schema from (time, country, zone, load[, source, ingested]) tuples."""
    def make(rows):
        full = []
        for r in rows:
            t, c, z, v = r[:4]
            src = r[4] if len(r) > 4 else None
            ing = r[5] if len(r) > 5 else None
            full.append((ts(t) if isinstance(t, str) else t, c, z, v, src,
                         ts(ing) if isinstance(ing, str) else ing))
        return spark.createDataFrame(full, T.StructType([T.StructField(f.name, f.dataType, True)
                                                         for f in RAW_SCHEMA.fields]))
    return make


def rows(df, *cols, order=None):
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)) if order is None else out
