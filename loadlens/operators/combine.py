"""Zip several one-row aggregates into one row without a cross join.

Each input contributes its own columns; ``unionByName`` fills the others with
nulls, and one global ``max`` per column picks the only non-null value. The
union holds one row per input, so the final aggregate is trivially small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zip_rows(*frames: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row (per ``by`` group) holding the columns of every input frame.

    Each input must have at most one row per group. An input without a row
    contributes nulls, like ``LEFT JOIN … ON TRUE``.
    """
    by = by or []
    cols: list[str] = []
    for f in frames:
        for c in f.columns:
            if c in by:
                continue
            if c in cols:
                raise ValueError(f"duplicate column {c!r} in zip_rows inputs")
            cols.append(c)
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.groupBy(*by).agg(*[F.max(c).alias(c) for c in cols])


def count_row(df: DataFrame, name: str) -> DataFrame:
    """A one-row frame with the row count of ``df`` under ``name``."""
    return df.agg(F.count(F.lit(1)).alias(name))
