"""Which steps a series has, as mergeable bitmaps.

A series' times on its step grid are numbered from the epoch; ``BITS`` consecutive
numbers are one bitmap of 4 KB (Spark's ``bitmap_construct_agg``), one row for each
(keys, phase, bucket). ``phase`` is where in a step the times lie, so a series whose
first time is off the grid keeps a grid of its own. Bitmaps are exact and merge by OR:
rows that arrive later, or twice, are folded in without reading what is stored of
the series, and expected, actual and missing steps follow from a few rows a zone,
with neither a generated spine nor a distinct over the observations.

A zone's bitmaps are many rows whatever its share of the data (hourly: one for 3.7
years, minutes: one for 22 days), and a partial aggregate holds one bitmap for each
(keys, phase, bucket) it meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.expr import epoch_span_steps
from loadlens.schema import HOURLY, SeriesSpec
from loadlens.session import read_version, write_version

#: Bits of one bitmap (fixed by Spark's bitmap functions).
BITS = 32768
_US = 1_000_000
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def presence_schema(spec: SeriesSpec = HOURLY) -> T.StructType:
    return T.StructType([*[T.StructField(k, T.StringType()) for k in spec.keys], T.StructField("phase", T.LongType()),
                         T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType()),
                         T.StructField("lo", T.TimestampNTZType()), T.StructField("hi", T.TimestampNTZType())])


def presence(df: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """``keys, phase, bucket, bits, lo, hi``: the times that ``df`` has. Rows without time count nothing."""
    step = spec.step_seconds * _US
    micros = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{spec.time}`)")
    placed = df.where(F.col(spec.time).isNotNull()).select(
        *spec.keys, F.col(spec.time).alias("_t"), F.pmod(micros, F.lit(step)).alias("phase"),
        micros.alias("_m"))
    number = F.expr(f"(_m - phase) div {step}")  # exact: the rest is taken off before
    return placed.withColumn("_n", number).groupBy(
        *spec.keys, "phase", F.expr(f"(_n - pmod(_n, {BITS})) div {BITS}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.expr(f"pmod(_n, {BITS})")).alias("bits"), F.min("_t").alias("lo"), F.max("_t").alias("hi"))


def merged(*parts: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """The union of what several presence tables have."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*spec.keys, "phase", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def read_presence(spark: SparkSession, path: str, spec: SeriesSpec = HOURLY) -> DataFrame:
    """A stored presence table, empty before the first update."""
    return read_version(spark, path, presence_schema(spec))


def update_presence(path: str, new_rows: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """Fold the times of ``new_rows`` into the table at ``path``; only the new rows and the bitmaps are read.

    Written as a new version beside the old one, so a crash leaves the table as it
    was, and the same rows folded in again change nothing.
    """
    spark = new_rows.sparkSession
    write_version(merged(read_presence(spark, path, spec), presence(new_rows, spec), spec=spec), path)
    return read_presence(spark, path, spec)


def _grids(table: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per keys first and last time and the phase of the first: the grid on which steps can be missing."""
    return table.groupBy(*spec.keys).agg(F.min("lo").alias("first"), F.max("hi").alias("last"),
                                         F.min_by("phase", "lo").alias("grid"))


def presence_counts(table: DataFrame, spec: SeriesSpec = HOURLY, by_zone: bool = False) -> DataFrame:
    """``expected_hours, actual_hours, missing_hours`` as ``quality.step_counts`` gives them, from bitmaps alone.

    Expected and actual are global unless ``by_zone``; missing is the sum over zones.
    """
    keys = list(spec.keys)
    per = table.groupBy(*keys, "phase").agg(
        F.sum(F.bitmap_count("bits")).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).groupBy(*keys).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min_by("n", "lo").alias("on_grid"), F.sum("n").alias("n"))
    span = F.expr(f"timestampdiff(MICROSECOND, lo, hi) div {spec.step_seconds * _US} + 1")
    zones = per.select(*keys, "lo", "hi", "n", (span - F.col("on_grid")).alias("gone"))
    if by_zone:
        return zones.select(*keys, epoch_span_steps(F.col("lo"), F.col("hi"), spec.step_seconds).alias("expected_hours"),
                            F.col("n").cast("bigint").alias("actual_hours"), F.col("gone").cast("bigint").alias("missing_hours"))
    # times that several zones have count once: their bitmaps are one by OR
    times = table.groupBy("phase", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).select(
        F.lit(None).cast("timestamp_ntz").alias("lo"), F.lit(None).cast("timestamp_ntz").alias("hi"), "n", F.lit(0).cast("bigint").alias("gone"))
    whole = zones.select("lo", "hi", F.lit(0).cast("bigint").alias("n"), "gone").unionByName(times)
    return whole.agg(epoch_span_steps(F.min("lo"), F.max("hi"), spec.step_seconds).alias("expected_hours"),
                     F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("actual_hours"),
                     F.coalesce(F.sum("gone"), F.lit(0)).cast("bigint").alias("missing_hours"))


def missing_from_presence(table: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """``keys, missing_time``: the steps between a series' first and last time that it lacks.

    A row for each bitmap between the two (absent ones are empty) goes to the tasks;
    only bytes that are not full become rows, and only their zero bits times.
    """
    keys, step = list(spec.keys), spec.step_seconds * _US
    grids = _grids(table, spec)

    number = f"((timestampdiff(MICROSECOND, {_EPOCH}, first) - grid) div {step})"
    spans = grids.select(*keys, "grid", F.expr(number).alias("_a"),
                         F.expr(f"timestampdiff(MICROSECOND, first, last) div {step}").alias("_k"))
    spans = spans.withColumn("_b", F.col("_a") + F.col("_k"))
    low, high = (F.expr(f"({c} - pmod({c}, {BITS})) div {BITS}") for c in ("_a", "_b"))
    buckets = spans.select(*keys, "grid", "_a", "_b", F.explode(F.sequence(low, high)).alias("bucket"))
    held = table.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("phase").alias("_p"), F.col("bucket").alias("_bucket"), "bits")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = buckets.join(held, [*same, F.col("grid") == F.col("_p"), F.col("bucket") == F.col("_bucket")], "left")
    begin = F.greatest(F.col("_a") - F.col("bucket") * BITS, F.lit(0))
    end = F.least(F.col("_b") - F.col("bucket") * BITS, F.lit(BITS - 1))
    byte = F.coalesce(F.conv(F.hex(F.substring("bits", F.col("_at") + 1, F.lit(1))), 16, 10).cast("int"), F.lit(0))
    bytes_ = joined.select(*keys, "grid", "bucket", "bits", begin.alias("_from"), end.alias("_to")).withColumn(
        "_at", F.explode(F.sequence(F.expr("cast(_from div 8 as int)"), F.expr("cast(_to div 8 as int)")))).withColumn(
        "_byte", byte).where("_byte < 255")
    bits = bytes_.withColumn("_bit", F.explode(F.sequence(F.lit(0), F.lit(7)))).where(
        "shiftright(_byte, _bit) & 1 = 0").withColumn("_i", F.col("_at") * 8 + F.col("_bit")).where("_i BETWEEN _from AND _to")
    # microseconds of whole steps since the epoch stay exact in 64 bits for any time Spark can hold
    at = F.timestamp_add("MICROSECOND", (F.col("bucket") * BITS + F.col("_i")) * F.lit(step) + F.col("grid"), F.expr(_EPOCH))
    return bits.select(*keys, at.alias("missing_time"))
