"""Keyed table maintenance on plain files: conflict-ignoring append, upsert,
high-water marks and the append-only run ledger.

Spark enforces no primary key, so every write path dedupes by key itself.
Per-key choices use ``min_by``/``max_by`` aggregates (combined map-side), never
a window over the key, so one hot key cannot pile up in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.expr import utc_now
from loadlens.session import read_or_empty, staged
from loadlens.schema import (CLEAN_SCHEMA, ERROR_MESSAGE_MAX, RAW_SCHEMA, RUN_EVENT_SCHEMA,
                             RUN_LEDGER_SCHEMA, RUN_STATUSES, STATE_SCHEMA)

ZONE_PART = "zone_part"
MARK_KEYS = ["pipeline_name", "country_code", "bidding_zone"]


def first_per_key(df: DataFrame, keys: list[str], order_col: str, last: bool = False) -> DataFrame:
    """Keep one row per key: the one with the smallest (or largest) ``order_col``."""
    payload = [c for c in df.columns if c not in keys]
    pick = (F.max_by if last else F.min_by)(F.struct(*payload), F.col(order_col)).alias("_row")
    return df.groupBy(*keys).agg(pick).select(*keys, "_row.*")


def append_ignore(existing: DataFrame, incoming: DataFrame, keys: list[str],
                  order_col: str | None = None) -> DataFrame:
    """S3: rows of ``incoming`` to insert when conflicts are ignored.

    First writer wins, also inside the batch (by ``order_col``). The number of
    rows inserted is the row count of the result (D9: not a driver counter).
    """
    batch = first_per_key(incoming, keys, order_col) if order_col else incoming.dropDuplicates(keys)
    # distinct keys: copies of one key in the stored table collapse map-side
    return batch.join(existing.select(*keys).distinct(), keys, "left_anti")


def rows_in_range(existing: DataFrame, batch: DataFrame, time_col: str = "time_utc",
                  partition_col: str = "month", zone: tuple[str, ...] = ("country_code", "bidding_zone")) -> DataFrame:
    """Existing rows that can collide with ``batch``: in the months its zones touch.

    The join is on the partition column, so Spark prunes the scan to the touched
    months at run time, however far apart they are; one zone that loads old data
    does not make the others' history be read.
    """
    out = existing
    if partition_col not in out.columns:
        out = out.withColumn(partition_col, F.date_format(time_col, "yyyy-MM"))
    touched = batch.select(F.date_format(time_col, "yyyy-MM").alias(partition_col), *zone).distinct()
    return out.join(touched, [partition_col, *zone], "left_semi")


def last_per_key(df: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """One row per key: the one of largest ``order_col``, or else of largest values."""
    payload = [c for c in df.columns if c not in keys]
    if order_col:
        return first_per_key(df, keys, order_col, last=True)
    return df.groupBy(*keys).agg(F.max(F.struct(*payload)).alias("_row")).select(*keys, "_row.*")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str],
           order_col: str | None = None) -> DataFrame:
    """The table after an upsert; an incoming row replaces the stored row.

    Of rows that repeat a key inside the batch the one with the largest
    ``order_col`` is kept, without it the one with the largest values.
    """
    batch = last_per_key(incoming, keys, order_col)
    cols = existing.columns
    kept = existing.join(batch.select(*keys), keys, "left_anti")
    return kept.select(*cols).unionByName(batch.select(*cols))


def upsert_table(spark: SparkSession, incoming: DataFrame, path: str, keys: list[str],
                 partition_col: str = "month", time_col: str = "time_utc",
                 order_col: str | None = None, zone_parts: int = 0) -> DataFrame:
    """Persist an upsert into a Parquet table partitioned by month of ``time_col``.

    Only the months the batch touches are read and rewritten (dynamic partition
    overwrite): their bounds prune the scan as literals, and a semi-join selects
    them. With ``zone_parts`` the months are further partitioned by a hash of the
    other keys (column ``zone_part``, the same number on every call), so that a
    small batch rewrites a part of a month and not the month of all zones. The merged rows are staged in the shared folder first, so the write
    never reads the files it replaces; the staged files go afterwards. A table
    that exists and cannot be read fails the call before anything is written.
    """
    incoming = incoming.withColumn(partition_col, F.date_format(time_col, "yyyy-MM"))
    parts = [partition_col]
    if zone_parts:
        parts.append(ZONE_PART)
        incoming = incoming.withColumn(ZONE_PART, F.pmod(
            F.xxhash64(*[k for k in keys if k != time_col]), F.lit(zone_parts)).cast("int"))
    schema = incoming.schema
    # within each file, rows sorted by (zone keys, time): row-group statistics then
    # let later zone/time filters skip data (the reference's (zone, time) index)
    layout = [k for k in keys if k != time_col] + [time_col]
    with staged(incoming, "upsert-batch") as batch:
        lo, hi = batch.agg(F.min(partition_col), F.max(partition_col)).first()
        if lo is None:  # nothing to write but the table itself
            return read_or_empty(spark, path, schema)
        touched = batch.select(*parts).distinct()
        existing = (read_or_empty(spark, path, schema)
                    .filter(F.col(partition_col).between(lo, hi))
                    .join(touched, parts, "left_semi").select(*schema.fieldNames()))
        with staged(upsert(existing, batch, keys, order_col), "upsert-merged") as merged:
            (merged.sortWithinPartitions(*layout)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*parts).parquet(path))
    return spark.read.schema(schema).parquet(path)


# ---------------------------------------------------------------- high-water marks

def state_lookup(requests: DataFrame, marks: DataFrame) -> DataFrame:
    """Each request row with its mark (null when none), many zones at once."""
    return requests.join(marks.select(*MARK_KEYS, "last_ingested_at_utc"), MARK_KEYS, "left")


def state_upsert(marks: DataFrame, new_marks: DataFrame, now: Column | None = None) -> DataFrame:
    """Set each zone's mark, touching ``updated_at_utc``.

    ``new_marks`` holds (pipeline, country, zone, last_ingested_at_utc); rows
    with a null mark are ignored (D18: only runs that parsed rows move marks).
    """
    now = now if now is not None else utc_now()
    fresh = (new_marks.filter(F.col("last_ingested_at_utc").isNotNull())
             .select(*MARK_KEYS, "last_ingested_at_utc", now.alias("updated_at_utc")))
    return upsert(marks.select(*STATE_SCHEMA.fieldNames()), fresh, MARK_KEYS)


# ---------------------------------------------------------------- run ledger

def run_event(df: DataFrame, event_seq: int | Column, **cols: Column) -> DataFrame:
    """Shape rows into ledger events; unspecified columns take their defaults.

    ``event_seq`` orders a run's events (a number, or a column when one frame
    carries several kinds of event). The status domain is checked on write
    with ``raise_error``.
    """
    defaults = {"rows_seen": F.lit(0), "rows_inserted": F.lit(0)}
    out = []
    for f in RUN_LEDGER_SCHEMA.fields:
        c = cols.get(f.name, defaults.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None)))
        if f.name == "error_message":
            c = F.substring(c.cast("string"), 1, ERROR_MESSAGE_MAX)
        if f.name == "status":
            c = F.when(c.isin(*RUN_STATUSES), c).otherwise(
                F.raise_error(F.concat(F.lit("invalid run status: "), F.coalesce(c, F.lit("null")))))
        out.append(c.cast(f.dataType).alias(f.name))
    seq = event_seq if isinstance(event_seq, Column) else F.lit(event_seq)
    return df.select(*out, seq.cast("int").alias("event_seq"))


def ledger_latest(events: DataFrame) -> DataFrame:
    """Latest state of every run (the event with the highest ``event_seq``)."""
    payload = [c for c in RUN_LEDGER_SCHEMA.fieldNames() if c != "run_id"]
    return (events.groupBy("run_id")
            .agg(F.max_by(F.struct(*payload), F.col("event_seq")).alias("_s"))
            .select("run_id", "_s.*"))


# ---------------------------------------------------------------- bootstrap

def bootstrap(spark: SparkSession) -> dict[str, DataFrame]:
    """Typed empty tables (defaults such as ingest time are added on write)."""
    return {
        "energy_load_raw": spark.createDataFrame([], RAW_SCHEMA),
        "energy_load_clean": spark.createDataFrame([], CLEAN_SCHEMA),
        "pipeline_run_events": spark.createDataFrame([], RUN_EVENT_SCHEMA),
        "pipeline_state": spark.createDataFrame([], STATE_SCHEMA),
    }


def with_ingest_default(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Raw-table default: ``ingested_at`` is the write time when not given."""
    now = now if now is not None else utc_now()
    if "ingested_at" not in rows.columns:
        rows = rows.withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))
    if "source" not in rows.columns:
        rows = rows.withColumn("source", F.lit(None).cast("string"))
    return rows.withColumn("ingested_at", F.coalesce(F.col("ingested_at"), now)).select(
        *RAW_SCHEMA.fieldNames())
