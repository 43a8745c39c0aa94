"""Data-quality layer: gaps, expected spine, missing steps, duplicates, reconciliation,
status ladder, assertions and the fail-the-run gate."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.expr import epoch_span_steps, floor_to
from loadlens.operators.clean import invalid_rows
from loadlens.operators.combine import count_row, zip_rows
from loadlens import fixed as FX
from loadlens.schema import HOURLY, SeriesSpec

log = logging.getLogger(__name__)

_US = 1_000_000
#: Spine rows that a task generates, about.
SPINE_ROWS = 10_000


def _bucket_unit(spec: SeriesSpec) -> str:
    return "day" if spec.step_seconds < 86400 else "month"


def previous_time(df: DataFrame, spec: SeriesSpec = HOURLY, bucket: str | None = None) -> DataFrame:
    """Add ``previous_time`` = LAG(time) per keys ordered by time.

    A plain ``lag`` over ``partitionBy(keys)`` puts a whole zone's history in
    one task. Instead the lag runs inside (keys, bucket) partitions and the
    first row of each bucket takes the previous non-empty bucket's maximum,
    found by a lag over the small per-bucket summary (one row per zone-bucket).
    Both branches start from one shuffle by (keys, bucket), which Spark runs
    once and reuses, so the input is computed once.
    """
    unit = bucket or _bucket_unit(spec)
    cols = [*spec.keys, "_bkt"]
    t = df.withColumn("_bkt", floor_to(F.col(spec.time), unit)).repartition(*cols)
    inner = t.withColumn("_lag", F.lag(spec.time).over(Window.partitionBy(*cols).orderBy(spec.time)))
    summary = (t.groupBy(*cols).agg(F.max(spec.time).alias("_bmax"))
               .withColumn("_prev_bmax",
                           F.lag("_bmax").over(Window.partitionBy(*spec.keys).orderBy("_bkt")))
               .select(*[F.col(c).alias(f"_s_{c}") for c in cols], "_prev_bmax"))
    # null-safe: rows of a null key still find their bucket's predecessor
    cond = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in cols]
    joined = inner.join(summary, cond, "left")
    return (joined.withColumn("previous_time", F.coalesce(F.col("_lag"), F.col("_prev_bmax")))
            .drop("_bkt", "_lag", "_prev_bmax", *[f"_s_{c}" for c in cols]))


def gap_micros(prev: Column, cur: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", prev, cur)


def time_gaps(clean: DataFrame, spec: SeriesSpec = HOURLY, bucket: str | None = None) -> DataFrame:
    """P5 + W1: consecutive points further apart than one step.

    Returns keys, previous_time, time, ``gap_interval`` (day-time interval) and
    ``gap_seconds`` (whole seconds, for engines whose interval text differs).
    """
    # Copies of one time do not change the gaps; dropping them first (map-side)
    # keeps a hot duplicated key from landing in one window partition.
    lagged = previous_time(clean.select(*spec.keys, spec.time).distinct(), spec, bucket)
    cur, prev = F.col(spec.time), F.col("previous_time")
    diff = gap_micros(prev, cur)
    return (lagged.filter(prev.isNotNull() & (diff > F.lit(spec.step_seconds * _US)))
            .select(*spec.keys, "previous_time", spec.time,
                    (cur - prev).alias("gap_interval"),
                    F.floor(diff / F.lit(_US)).cast("bigint").alias("gap_seconds")))


def series_bounds(clean: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """First and last time per keys."""
    return clean.groupBy(*spec.keys).agg(F.min(spec.time).alias("min_time"),
                                         F.max(spec.time).alias("max_time"))


def expected_spine(clean: DataFrame, spec: SeriesSpec = HOURLY, chunk_steps: int = 256,
                   time_col: str = "expected_time") -> DataFrame:
    """Min, min+step, … ≤ max per keys, anchored at each zone's own minimum.

    Generated in two levels: one row per chunk of ``chunk_steps`` steps, spread
    over tasks by a shuffle on (keys, chunk), then the steps inside a chunk. No
    single row ever holds a zone's whole spine as one array.
    """
    step_us = spec.step_seconds * _US
    bounds = series_bounds(clean, spec).filter(F.col("min_time").isNotNull())
    n_steps = F.expr(f"timestampdiff(MICROSECOND, min_time, max_time) div {step_us}")
    # An explicit partition count: adaptive execution would size this shuffle by
    # the chunk rows (tiny) and merge them into a few tasks, while each chunk row
    # becomes up to ``chunk_steps`` spine rows after the explode. It follows from
    # the length of the spine, up to the session's number of partitions.
    steps = bounds.agg(F.sum(n_steps + 1)).first()[0] or 0
    parts = max(1, min(int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-steps // SPINE_ROWS)))
    chunks = (bounds.withColumn("_k", n_steps)
              .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                     F.expr(f"_k div {chunk_steps}"))))
              .repartition(parts, *spec.keys, "_c"))
    lo = F.col("_c") * chunk_steps
    hi = F.least(lo + (chunk_steps - 1), F.col("_k"))
    steps = chunks.withColumn("_i", F.explode(F.sequence(lo, hi)))
    return steps.select(
        *spec.keys,
        F.timestamp_add("SECOND", F.col("_i") * spec.step_seconds, F.col("min_time")).alias(time_col))


def missing_times(clean: DataFrame, spec: SeriesSpec = HOURLY, chunk_steps: int = 256) -> DataFrame:
    """J2 + R1: spine points with no observation at exactly that time."""
    spine = expected_spine(clean, spec, chunk_steps, time_col=spec.time)
    present = clean.select(*spec.keys, spec.time).distinct()
    return (spine.join(present, [*spec.keys, spec.time], "left_anti")
            .select(*spec.keys, F.col(spec.time).alias("missing_time")))


def invalid_loads(df: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """P2 as the DQ view (works on clean for parity, on raw to be useful)."""
    return invalid_rows(df, spec)


def duplicate_key_groups(raw: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """G10 + P8: (time, keys) groups holding more than one row.

    A count per key combines map-side, so a hot key costs one row per task.
    """
    return (raw.groupBy(*spec.key_time).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def expected_steps(clean: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """One row, global (max - min) / step + 1 rounded to a whole number."""
    return clean.agg(epoch_span_steps(F.min(spec.time), F.max(spec.time), spec.step_seconds)
                     .alias("expected_hours"))


def actual_steps(clean: DataFrame, spec: SeriesSpec = HOURLY, approx: bool = False) -> DataFrame:
    """Distinct observation times over all zones (global, as in the reference)."""
    agg = F.approx_count_distinct(spec.time) if approx else F.count_distinct(F.col(spec.time))
    return clean.agg(agg.alias("actual_hours"))


def step_counts(clean: DataFrame, spec: SeriesSpec = HOURLY, by_zone: bool = False) -> DataFrame:
    """G9 + G13 + J2 counts in one pass: ``expected_hours, actual_hours, missing_hours``.

    No spine is generated: a zone's missing steps are the steps of its span less the
    distinct times it has on its own grid. Times are grouped by their phase to the
    step; the phase group that holds the zone's first time is its grid. Expected and
    actual are global unless ``by_zone``, as in the reference; missing is the sum
    over zones.
    """
    keys, t = list(spec.keys), F.col(spec.time)
    step = spec.step_seconds * _US
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)
    times = clean.filter(t.isNotNull()).select(*keys, spec.time, F.pmod(micros, F.lit(step)).alias("_phase")).distinct()
    zones = times.groupingSets([[*keys, "_phase"], [spec.time]], *keys, "_phase", spec.time).agg(
        F.grouping(spec.time).alias("_z"), F.count(F.lit(1)).alias("_n"), F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    of_zone = F.col("_z") == 1
    if by_zone:
        zones = zones.filter(of_zone)
    # distinct times count once each: their group is one row here whatever its size
    per = zones.groupBy(*keys, (~of_zone).alias("_time")).agg(
        F.min("_lo").alias("lo"), F.max("_hi").alias("hi"), F.min_by("_n", "_lo").alias("on_grid"), F.count(F.lit(1)).alias("n"),
        F.sum("_n").alias("in_zone"))
    span = F.expr(f"timestampdiff(MICROSECOND, lo, hi) div {step} + 1")
    missing = F.when(~F.col("_time"), span - F.col("on_grid"))
    if by_zone:
        return per.select(*keys, epoch_span_steps(F.col("lo"), F.col("hi"), spec.step_seconds).alias("expected_hours"),
                          F.col("in_zone").alias("actual_hours"), missing.cast("bigint").alias("missing_hours"))
    return per.agg(
        epoch_span_steps(F.min("lo"), F.max("hi"), spec.step_seconds).alias("expected_hours"),
        F.coalesce(F.max(F.when(F.col("_time"), F.col("n"))), F.lit(0)).cast("bigint").alias("actual_hours"),
        F.coalesce(F.sum(missing), F.lit(0)).cast("bigint").alias("missing_hours"))


def latest_success(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    """T2 + P7: most recent successful run (ties: larger run id); 0 or 1 row per group."""
    by = by or []
    pick = F.max_by(F.struct("run_id", "started_at_utc", "finished_at_utc"),
                    F.struct("started_at_utc", "run_id")).alias("_r")
    agg = ledger.filter(F.col("status") == "success").groupBy(*by).agg(pick)
    return (agg.filter(F.col("_r").isNotNull())
            .select(*by, F.col("_r.run_id").alias("last_run_id"),
                    F.col("_r.started_at_utc").alias("last_run_started_at"),
                    F.col("_r.finished_at_utc").alias("last_run_finished_at")))


def reconciliation(clean: DataFrame, raw: DataFrame, ledger: DataFrame, spec: SeriesSpec = HOURLY,
                   missing: DataFrame | None = None, by_zone: bool = False) -> DataFrame:
    """Q1: expected / actual / missing / duplicate counts and the last successful run.

    Global (one row) as in the reference; ``by_zone=True`` gives one row per
    zone with the zone's own span, counts and latest run (D5).
    """
    by = list(spec.keys) if by_zone else []
    steps = step_counts(clean, spec, by_zone)
    if missing is not None:
        steps = zip_rows(steps.drop("missing_hours"), missing.groupBy(*by).agg(F.count(F.lit(1)).alias("missing_hours")), by=by)
    out = zip_rows(
        steps,
        duplicate_key_groups(raw, spec).groupBy(*by).agg(F.count(F.lit(1)).alias("duplicate_rows")),
        latest_success(ledger, by=by),
        by=by,
    )
    if by_zone:
        out = (out.withColumn("missing_hours", F.coalesce("missing_hours", F.lit(0)))
               .withColumn("duplicate_rows", F.coalesce("duplicate_rows", F.lit(0))))
    return out


def pipeline_status(raw: DataFrame, clean: DataFrame, spec: SeriesSpec = HOURLY,
                    missing: DataFrame | None = None, gaps: DataFrame | None = None,
                    invalid: DataFrame | None = None, warn_over: int = FX.STATUS_WARN_OVER) -> DataFrame:
    """Q2: five counts and the status ladder (first match wins)."""
    missing_count = (step_counts(clean, spec).select("missing_hours") if missing is None
                     else count_row(missing, "missing_hours"))
    gaps = gaps if gaps is not None else time_gaps(clean, spec)
    if invalid is None:  # count clean rows and invalid ones in one pass (D4: parity form)
        v = F.col(spec.value)
        clean_counts = clean.agg(F.count(F.lit(1)).alias("clean_rows"),
                                 F.count_if(v.isNull() | (v < 0)).alias("invalid_loads"))
    else:
        clean_counts = zip_rows(count_row(clean, "clean_rows"), count_row(invalid, "invalid_loads"))
    counts = zip_rows(count_row(raw, "raw_rows"), clean_counts,
                      missing_count, count_row(gaps, "time_gaps"))
    status = (F.when(F.col("clean_rows") == 0, FX.STATUS_FAILED)
              .when(F.col("invalid_loads") > 0, FX.STATUS_FAILED)
              .when(F.col("missing_hours") > warn_over, FX.STATUS_WARNING)
              .when(F.col("time_gaps") > warn_over, FX.STATUS_WARNING)
              .otherwise(FX.STATUS_HEALTHY))
    return counts.withColumn("pipeline_status", status)


@dataclass(frozen=True)
class AssertionProfile:
    """Thresholds of the three assertions. ``missing_op`` is '=' or '<='."""

    missing_op: str
    missing_limit: int
    missing_rule: str
    coverage_slack: int


STRICT = AssertionProfile("=", FX.STRICT_LIMIT, FX.STRICT_MISSING_RULE, FX.STRICT_LIMIT)
TOLERANT = AssertionProfile("<=", FX.TOLERANT_LIMIT, FX.TOLERANT_MISSING_RULE, FX.TOLERANT_LIMIT)


def assertions(recon: DataFrame, profile: AssertionProfile = TOLERANT) -> DataFrame:
    """Q3 + U1: three assertion rows from the reconciliation row in one pass.

    A null comparison is not true, so it falls to FAIL, as a CASE would.
    """
    m, d = F.col("missing_hours"), F.col("duplicate_rows")
    a, e = F.col("actual_hours"), F.col("expected_hours")
    missing_ok = (m == profile.missing_limit) if profile.missing_op == "=" else (m <= profile.missing_limit)

    def row(name: str, ok: Column, observed: Column, rule: str) -> Column:
        return F.struct(F.lit(name).alias("assertion_name"),
                        F.when(ok, FX.PASS).otherwise(FX.FAIL).alias("status"),
                        observed.cast("bigint").alias("observed_value"),
                        F.lit(rule).alias("rule"))

    return recon.select(F.inline(F.array(
        row(FX.MISSING_CHECK, missing_ok, m, profile.missing_rule),
        row(FX.DUPLICATE_CHECK, d == 0, d, FX.DUPLICATE_RULE),
        row(FX.COVERAGE_CHECK, a >= e - profile.coverage_slack, a, FX.COVERAGE_RULE),
    )))


def failing_count(assertion_rows: DataFrame) -> DataFrame:
    """One row with the number of failing assertions."""
    return assertion_rows.agg(F.count_if(F.col("status") == FX.FAIL).alias("fail_count"))


class DataQualityError(RuntimeError):
    """Raised by :func:`dq_gate` when any assertion fails."""


def dq_gate(assertion_rows: DataFrame) -> int:
    """Q4: stop the run when any assertion fails. Returns the (zero) fail count.

    The profile has three assertions, so three rows reach the driver, evaluated once.
    """
    failing = [r for r in assertion_rows.collect() if r["status"] == FX.FAIL]
    for r in failing:
        log.error("DQ assertion failed: %s observed=%s rule=%s",
                  r["assertion_name"], r["observed_value"], r["rule"])
    if failing:
        raise DataQualityError(f"DQ validation failed: {len(failing)} failing assertion(s)")
    return 0


def not_null_checks(df: DataFrame, columns: list[str], model: str) -> DataFrame:
    """Q5: null count per declared column in one aggregate, as long rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                 F.col(c).alias("null_rows"),
                 F.when(F.col(c) == 0, FX.PASS).otherwise(FX.FAIL).alias("status"))
        for c in columns])))
