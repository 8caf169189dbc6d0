from tidewell.functions.columns import (
    ascending, descending, mean, month_gap, month_start, percent, ratio, rounded, top, weekday_number,
)

__all__ = [
    "ascending", "descending", "mean", "month_gap", "month_start", "percent", "ratio", "rounded",
    "top", "weekday_number",
]
