"""Column-level helpers: every function takes and returns ``Column`` objects
built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from basketry.functions.rules import (
    CHURN_LEVELS,
    churn_flag,
    churn_rank,
    churn_from_rank,
    clv_group,
    display_number,
    null_safe_flag,
    period_part,
    rfm_segment,
    round_half_up,
    tercile_code,
)
from basketry.functions.timestamps import (
    ISO_UTC_PATTERN,
    parse_iso_utc,
    time_of_day,
)

__all__ = [
    "CHURN_LEVELS",
    "ISO_UTC_PATTERN",
    "churn_flag",
    "churn_rank",
    "churn_from_rank",
    "clv_group",
    "display_number",
    "null_safe_flag",
    "parse_iso_utc",
    "period_part",
    "rfm_segment",
    "round_half_up",
    "tercile_code",
    "time_of_day",
]
