"""Publish layer: declared extracts, full-refresh writes, JSON-lines export,
format-agnostic connector I/O and typed staging views.

All writes run on executors; nothing is fetched to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.schema import PUBLISH_ORDER, PUBLISH_SCHEMAS
from loadlens.session import version_path, write_version


def declared_select(df: DataFrame, object_name: str, order: bool = False) -> DataFrame:
    """S9 (+T4): explicit column list, order and declared types of one object.

    Interval columns are published as text; ordering is applied only when a
    consumer needs it (``order=True``), never inside operators.
    """
    schema = PUBLISH_SCHEMAS[object_name]
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if order and object_name in PUBLISH_ORDER:
        out = out.orderBy(*PUBLISH_ORDER[object_name])
    return out


def publish(df: DataFrame, object_name: str, path: str, fmt: str = "parquet",
            options: dict | None = None, sort_within: list[str] | None = None) -> None:
    """S10 + T4: full refresh of one object with its declared schema and order.

    The new rows are written as the next version beside the current one, which
    readers (:func:`read_published`) see until the write is complete: a failed
    refresh leaves the object as it was. An empty result still replaces the
    target with an empty, schema-bearing version. Objects with a declared order
    are range-sorted by it; ``sort_within`` lays the rows of other objects out for
    row-group statistics without a global sort.
    """
    out = declared_select(df, object_name, order=not sort_within)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    write_version(out, path, fmt, options)


def read_published(spark: SparkSession, path: str, object_name: str, fmt: str = "parquet",
                   options: dict | None = None) -> DataFrame:
    """The current version of a published object."""
    schema = PUBLISH_SCHEMAS[object_name]
    last = version_path(spark, path)
    return spark.createDataFrame([], schema) if last is None else read_table(spark, last, fmt, options, schema)


def iso_text(c: Column, dtype: T.DataType) -> Column:
    """ISO-8601 text as Python's ``isoformat``: fraction only when non-zero,
    ``+00:00`` offset for zoned timestamps (rendered in the session zone)."""
    zone = "xxx" if isinstance(dtype, T.TimestampType) else ""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss" + zone)
    frac = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" + zone)
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(frac)


def export_ndjson(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON with ISO-8601 times, nulls kept, decimals as floats."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = iso_text(c, f.dataType)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    df.select(*cols).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


NDJSON_READ_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
                       "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
                       "dateFormat": "yyyy-MM-dd", "mode": "FAILFAST"}


def read_ndjson(spark: SparkSession, path: str, object_name: str) -> DataFrame:
    """Read an S11 export back with the object's declared schema."""
    return spark.read.schema(PUBLISH_SCHEMAS[object_name]).options(**NDJSON_READ_OPTIONS).json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Read any Spark data source; Parquet by default."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(df: DataFrame, path: str | None = None, fmt: str = "parquet",
                options: dict | None = None, mode: str = "overwrite") -> None:
    """Overwrite through any Spark data source (connector options pass through)."""
    w = df.write.mode(mode).format(fmt).options(**(options or {}))
    w.save(path) if path is not None else w.save()


def stg_clean(df: DataFrame) -> DataFrame:
    """Typed staging view over the synced clean table."""
    return df.select(
        F.col("time_utc").cast("timestamp_ntz").alias("time_utc"),
        "country_code", "bidding_zone",
        F.col("load_mw").cast("double").alias("load_mw"),
        "source",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
    )


def stg_assertions(df: DataFrame) -> DataFrame:
    """Typed staging view over the synced assertions."""
    return df.select("assertion_name", "status",
                     F.col("observed_value").cast("bigint").alias("observed_value"), "rule")


def materialise(spark: SparkSession, df: DataFrame, name: str, kind: str = "view",
                path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Expose an object as a view (recomputed on read) or a table (written once).

    A table is written to ``path`` and the view is re-pointed at the written
    data, so downstream objects read the materialised rows.
    """
    if kind == "table":
        if path is None:
            raise ValueError("a table needs a path")
        df.write.mode("overwrite").format(fmt).save(path)
        df = spark.read.format(fmt).load(path)
    elif kind != "view":
        raise ValueError(f"unknown materialisation {kind!r}")
    df.createOrReplaceTempView(name)
    return df


def zone_metrics_job(spark: SparkSession, source: str, target: str, fmt: str = "parquet",
                     read_options: dict | None = None, write_options: dict | None = None,
                     exact_scale: int | None = None) -> dict:
    """S12 + G14 + G16: read clean through a connector, aggregate per zone, overwrite.

    Input and output row counts are observed metrics of the single write job
    (no separate ``count()`` passes over the source).
    """
    from pyspark.sql import Observation

    from loadlens.operators.analytics import zone_metrics

    seen_in, seen_out = Observation("zone_metrics_input"), Observation("zone_metrics_output")
    src = read_table(spark, source, fmt, read_options).observe(seen_in, F.count(F.lit(1)).alias("rows"))
    result = zone_metrics(src, exact_scale=exact_scale).observe(seen_out, F.count(F.lit(1)).alias("rows"))
    write_table(result, target, fmt, write_options)
    return {"input_rows": seen_in.get["rows"], "output_rows": seen_out.get["rows"],
            "input_schema": src.schema.simpleString(), "output_schema": result.schema.simpleString()}


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose built objects as temp views (views are rebuilt each time)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
