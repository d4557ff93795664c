"""Codes and numbers to the texts a report shows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.schemas import MONTH_LABELS, WEEKDAY_LABELS


def weekday_number(date: Column) -> Column:
    """Day of week with 0 for Saturday, the encoding of ``order_dow``."""
    return (F.dayofweek(date) % 7).cast("int")


def _label(names: tuple[str, ...], position: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def weekday_label(order_dow: Column) -> Column:
    return _label(WEEKDAY_LABELS, order_dow + 1)


def month_label(month: Column) -> Column:
    return _label(MONTH_LABELS, month)


def percent_text(share: Column) -> Column:
    """``0.5897`` as ``59.0%``."""
    return F.format_string("%.1f%%", share * 100)


def thousands_text(count: Column) -> Column:
    """``3421083`` as ``3,421,083``."""
    return F.format_number(count, 0)
