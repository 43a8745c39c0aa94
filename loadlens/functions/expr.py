"""Scalar and aggregate column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadlens.fixed import RESOLUTION_MINUTES


def floor_to(c: Column, unit: str) -> Column:
    """Truncate a wall-clock (TIMESTAMP_NTZ) value to ``unit``, staying NTZ.

    Built from its own fields, so no session time zone is involved
    (``date_trunc`` would round-trip through a zoned TIMESTAMP).
    """
    zero = F.lit(0)
    y, m, d, h = F.year(c), F.month(c), F.dayofmonth(c), F.hour(c)
    if unit == "hour":
        parts = (y, m, d, h)
    elif unit == "day":
        parts = (y, m, d, zero)
    elif unit == "month":
        parts = (y, m, F.lit(1), zero)
    elif unit == "quarter":
        parts = (y, (F.quarter(c) - 1) * 3 + 1, F.lit(1), zero)
    elif unit == "year":
        parts = (y, F.lit(1), F.lit(1), zero)
    else:
        raise ValueError(f"unsupported unit {unit!r}")
    return F.make_timestamp_ntz(*parts, zero, zero)


def mean(c: Column | str, exact_scale: int | None = None) -> Column:
    """Average; with ``exact_scale`` the sum runs over DECIMAL(18, scale).

    Decimal sums are associative, so the result does not depend on the order
    partial aggregates are merged in (plain double ``avg`` differs in the last
    bits between engines and between plans).
    """
    c = F.col(c) if isinstance(c, str) else c
    if exact_scale is None:
        return F.avg(c)
    return exact_sum(c, exact_scale).cast("double") / F.count(c)


def exact_value(c: Column, exact_scale: int = 6) -> Column:
    """The value as DECIMAL(18, scale).

    A value that does not fit (1e12 or more at scale 6, or not finite) fails the
    query, with ANSI mode on or off; it is never left out of a sum.
    """
    kind = f"decimal(18,{exact_scale})"
    fits = c.try_cast(kind)
    return F.when(c.isNull() | fits.isNotNull(), fits).otherwise(F.raise_error(F.concat(
        F.lit(f"value does not fit {kind}: "), c.cast("string"))).cast(kind))


def exact_sum(c: Column, exact_scale: int = 6) -> Column:
    """Sum over DECIMAL(18, scale): exact, so independent of the order of merging."""
    return F.sum(exact_value(c, exact_scale))


def resolution_minutes(code: Column) -> Column:
    """Resolution code -> minutes; any other non-null code fails the query."""
    ladder = None
    for k, minutes in RESOLUTION_MINUTES.items():
        ladder = (F.when(code == k, F.lit(minutes)) if ladder is None
                  else ladder.when(code == k, F.lit(minutes)))
    return ladder.when(code.isNull(), F.lit(None).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("Unsupported resolution "), code)).cast("int"))


def pct_deviation(x: Column, base: Column, places: int = 2) -> Column:
    """round((x - base) / base * 100, places); null when base is zero."""
    return F.round(F.try_divide(x - base, base) * F.lit(100.0), places)


def epoch_span_steps(lo: Column, hi: Column, step_seconds: int) -> Column:
    """Whole number of steps in [lo, hi] counting both ends (round, then cast)."""
    secs = F.timestamp_diff("SECOND", lo, hi)
    return F.round(secs / F.lit(float(step_seconds)) + F.lit(1.0)).cast("bigint")


def interval_text(seconds: Column, micros: Column | None = None) -> Column:
    """Day-time interval text: '02:00:00', '1 day 01:00:00', '3 days …'.

    ``micros``, the part of a second, is shown if it is not zero, without
    trailing zeros: '00:00:01.5'.
    """
    d = F.floor(seconds / 86400)
    rem = seconds - d * 86400
    hh = F.lpad(F.floor(rem / 3600).cast("string"), 2, "0")
    mm = F.lpad(F.floor((rem % 3600) / 60).cast("string"), 2, "0")
    ss = F.lpad((rem % 60).cast("string"), 2, "0")
    days = (F.when(d == 1, F.lit("1 day "))
            .when(d > 1, F.concat(d.cast("string"), F.lit(" days "))).otherwise(F.lit("")))
    whole = F.concat(days, hh, F.lit(":"), mm, F.lit(":"), ss)
    if micros is None:
        return whole
    part = F.regexp_replace(F.lpad(micros.cast("string"), 6, "0"), "0+$", "")
    return F.when(micros == 0, whole).otherwise(F.concat(whole, F.lit("."), part))


_NTZ_EPOCH = "1970-01-01 00:00:00"


def ntz_to_instant(c: Column) -> Column:
    """Wall-clock NTZ -> TIMESTAMP at the same UTC instant, independent of session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(_NTZ_EPOCH).cast("timestamp_ntz"), c))


def instant_to_ntz(c: Column) -> Column:
    """TIMESTAMP -> its UTC wall clock as NTZ, independent of session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_NTZ_EPOCH).cast("timestamp_ntz"))


def utc_now() -> Column:
    """Current time as a UTC wall-clock TIMESTAMP_NTZ (whatever the session zone)."""
    return instant_to_ntz(F.current_timestamp())
