"""Column expressions shared by the operators and plans."""

from tradewind.functions.calendar import (
    day_name,
    day_of_week,
    days_between,
    hour_of_day,
    month_bucket,
    months_elapsed,
    whole_days,
)
from tradewind.functions.measures import (
    change_pct,
    delta_direction,
    fault_flags,
    late_flag,
    primary_driver,
    ratio,
    safe_ratio_pct,
)
from tradewind.functions.text import (
    blank_to_null,
    default_value,
    display_label,
    is_missing,
    route_label,
    safe_cast,
    title_case,
    typed,
    upper_code,
)

__all__ = [
    "blank_to_null",
    "change_pct",
    "day_name",
    "day_of_week",
    "days_between",
    "default_value",
    "delta_direction",
    "display_label",
    "fault_flags",
    "hour_of_day",
    "is_missing",
    "late_flag",
    "month_bucket",
    "months_elapsed",
    "primary_driver",
    "ratio",
    "route_label",
    "safe_cast",
    "safe_ratio_pct",
    "title_case",
    "typed",
    "upper_code",
    "whole_days",
]
