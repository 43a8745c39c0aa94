"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from loadlens.functions.expr import (  # noqa: F401
    epoch_span_steps,
    exact_sum,
    floor_to,
    interval_text,
    mean,
    pct_deviation,
    resolution_minutes,
)
