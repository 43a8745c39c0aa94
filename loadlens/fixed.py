"""Fixed values.

These must equal the reference's for the published results to be the same:
labels, rule texts, thresholds, codes and formats. Everything else in the
package is a parameter.
"""

# Clean layer and run ledger.
DEFAULT_SOURCE = "ENTSO-E"
RUN_STATUSES = ("running", "success", "failed")
ERROR_MESSAGE_MAX = 2000

# Market documents (resolution code -> minutes, period start text).
RESOLUTION_MINUTES = {"PT60M": 60, "PT15M": 15}
START_FORMAT = "yyyy-MM-dd'T'HH:mm'Z'"

# Anomaly band and labels.
ANOMALY_HIGH_FACTOR = 1.10
ANOMALY_LOW_FACTOR = 0.90
HIGH_ANOMALY = "HIGH_ANOMALY"
LOW_ANOMALY = "LOW_ANOMALY"

# Pipeline status ladder.
STATUS_FAILED = "FAILED"
STATUS_WARNING = "WARNING"
STATUS_HEALTHY = "HEALTHY"
STATUS_WARN_OVER = 24

# Assertions (names, outcomes, rule texts, limits of the two profiles).
PASS = "PASS"
FAIL = "FAIL"
MISSING_CHECK = "missing_hours_check"
DUPLICATE_CHECK = "duplicate_rows_check"
COVERAGE_CHECK = "data_coverage_check"
STRICT_MISSING_RULE = "expected_missing_hours = 20"
TOLERANT_MISSING_RULE = "missing_hours <= 50"
DUPLICATE_RULE = "duplicate_rows = 0"
COVERAGE_RULE = "actual_hours close to expected_hours"
STRICT_LIMIT = 20
TOLERANT_LIMIT = 50

# Mart seasons and curve-shape hours.
WINTER_MONTHS = (12, 1, 2)
SUMMER_MONTHS = (6, 7, 8)
SHAPE_HOURS = {"avg_midnight_load_mw": 0, "avg_morning_load_mw": 6, "avg_evening_load_mw": 18}
