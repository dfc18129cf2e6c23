from .dates import day_name, period_label, week_start
from .numbers import average, clip_fraction, flag, in_lakhs, percent, rounded_ratio
from .text import normalize, strip, title_case

__all__ = [
    "average",
    "clip_fraction",
    "day_name",
    "flag",
    "in_lakhs",
    "normalize",
    "percent",
    "period_label",
    "rounded_ratio",
    "strip",
    "title_case",
    "week_start",
]
