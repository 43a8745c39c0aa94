"""Tables of the session catalog: stored column defaults, checked inserts, bucketed storage.

The declared tables (S16) are created by DDL from the schemas of :mod:`loadlens.schema`.
Spark keeps column defaults of a file table and fills them in on insert, but it drops
NOT NULL and knows no unique key, so :func:`insert_rows` refuses nulls itself and
:func:`append_new` leaves out rows whose key is stored.

With ``buckets`` a table is clustered and sorted by its whole key, time included: a
zone of a third of the rows lies in all buckets. A join on the key then reads the
stored side bucket by bucket, without moving it; only the batch is shuffled. An
append adds a file to each bucket it touches (``spark.sql.bucketing`` must stay on).

Cases: rows of no columns but the required ones take the defaults; a column that the
table lacks, a required one that is missing, and a null in a required one are errors,
and nothing is stored; rows that repeat a key in a batch count once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.operators.tables import MARK_KEYS, first_per_key
from loadlens.schema import CLEAN_SCHEMA, HOURLY, RAW_SCHEMA, RUN_EVENT_SCHEMA, STATE_SCHEMA

#: The UTC wall clock at the time of an insert.
NOW = "convert_timezone(current_timezone(), 'UTC', localtimestamp())"


@dataclass(frozen=True)
class TableSpec:
    """Schema (its non-null columns are required), SQL defaults by column, and unique key of a table."""

    schema: T.StructType
    defaults: dict[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


TABLES = {
    "energy_load_raw": TableSpec(RAW_SCHEMA, {"ingested_at": NOW}, tuple(HOURLY.key_time)),
    "energy_load_clean": TableSpec(CLEAN_SCHEMA, {}, tuple(HOURLY.key_time)),
    "pipeline_run_events": TableSpec(RUN_EVENT_SCHEMA, {"rows_seen": "0", "rows_inserted": "0"}, ("run_id", "event_seq")),
    "pipeline_state": TableSpec(STATE_SCHEMA, {}, tuple(MARK_KEYS)),
}


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """A database, by default in the session's warehouse folder."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def create_table(spark: SparkSession, name: str, spec: TableSpec, buckets: int = 0, fmt: str = "parquet") -> None:
    """The empty table by DDL, unless it is there."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
               + (f" DEFAULT {spec.defaults[f.name]}" if f.name in spec.defaults else "") for f in spec.schema.fields]
    key = ", ".join(f"`{k}`" for k in spec.key)
    layout = f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {fmt}{layout}")


def create_tables(spark: SparkSession, database: str, location: str | None = None, buckets: int = 0) -> dict[str, str]:
    """Every declared table in ``database``; their full names."""
    create_database(spark, database, location)
    names = {name: f"{database}.{name}" for name in TABLES}
    for name, full in names.items():
        create_table(spark, full, TABLES[name], buckets)
    return names


def bucket_count(spark: SparkSession, name: str) -> int:
    """Buckets of a table as the catalog has them (0: none)."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    return int(found["data_type"]) if found else 0


def checked(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns that ``rows`` has, in its types; a null in a required one fails the write."""
    given = [f for f in spec.schema.fields if f.name in rows.columns]
    unknown = set(rows.columns) - {f.name for f in given}
    missing = [c for c in spec.required if c not in rows.columns and c not in spec.defaults]
    if unknown or missing:
        raise ValueError(f"columns unknown: {sorted(unknown)}, required but missing: {missing}")
    out = []
    for f in given:
        value = F.col(f"`{f.name}`").cast(f.dataType)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"null in required column {f.name}")).cast(f.dataType))
        out.append(value.alias(f.name))
    return rows.select(*out)


def insert_rows(spark: SparkSession, name: str, rows: DataFrame, spec: TableSpec) -> None:
    """Append by column name; columns that ``rows`` lacks take the stored defaults."""
    out = checked(rows, spec)
    buckets = bucket_count(spark, name)
    if buckets:  # a task for each bucket, so that an append adds one file to each
        out = out.repartition(buckets, *spec.key)
    columns = ", ".join(f"`{c}`" for c in out.columns)
    spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {{rows}}", rows=out)


def new_rows(spark: SparkSession, name: str, incoming: DataFrame, spec: TableSpec, order_col: str | None = None) -> DataFrame:
    """One row (the first by ``order_col``) of each key that the table does not hold.

    Copies of a key are combined map-side first. Then the batch is laid out as the table's
    buckets are; left to itself, the planner takes the side of more partitions and moves the
    other. An anti-join would be pushed below that layout, so an outer join marks the held keys.
    """
    key = list(spec.key)
    batch = first_per_key(incoming, key, order_col) if order_col else incoming.dropDuplicates(key)
    buckets = bucket_count(spark, name)
    if buckets:
        batch = batch.repartition(buckets, *key)
    held = spark.table(name).select(*key, F.lit(True).alias("_held"))
    return batch.join(held, key, "left").where(F.col("_held").isNull()).drop("_held")


def append_new(spark: SparkSession, name: str, incoming: DataFrame, spec: TableSpec, order_col: str | None = None) -> DataFrame:
    """S3 on a stored table: conflicts are ignored, the first writer wins. Returns the table."""
    fresh = new_rows(spark, name, incoming, spec, order_col)
    insert_rows(spark, name, fresh.drop(order_col) if order_col and order_col not in spec.schema.fieldNames() else fresh, spec)
    return spark.table(name)


def save_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """An object as a table of the catalog, replaced whole, and read back by its name."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
