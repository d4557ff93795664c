"""Column expressions shared by the operators."""

from basketry.functions.labels import (
    month_label,
    percent_text,
    thousands_text,
    weekday_label,
    weekday_number,
)
from basketry.functions.text import (
    long_enough,
    mentions_or_missing,
    present,
    strip_prefix,
)
from basketry.functions.vectors import cosine, dot, norm, unit

__all__ = [
    "cosine", "dot", "long_enough", "mentions_or_missing", "month_label",
    "norm", "percent_text", "present", "strip_prefix", "thousands_text", "unit",
    "weekday_label", "weekday_number",
]
