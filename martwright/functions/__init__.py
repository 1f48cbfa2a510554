from .calendar import calendar_columns, month_label, month_label_padded
from .money import half_up_ratio, line_total, null_safe_ratio
from .text import full_name, parse_day_month_year, text_after_nth, upper_text

__all__ = [
    "calendar_columns",
    "full_name",
    "half_up_ratio",
    "line_total",
    "month_label",
    "month_label_padded",
    "null_safe_ratio",
    "parse_day_month_year",
    "text_after_nth",
    "upper_text",
]
