"""Column expressions shared by the plans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 0 degrees Celsius on the Kelvin scale.
KELVIN_OFFSET = 273.15


def kelvin_to_celsius(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return (column - F.lit(KELVIN_OFFSET)).cast("double")


def first_item(array: str | Column, field: str) -> Column:
    """A field of the first array element; null on an empty array."""
    return F.get(array, F.lit(0)).getField(field)


def from_epoch(seconds: str | Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_seconds(instant: str | Column) -> Column:
    """Whole seconds since 1970, floored."""
    return F.unix_seconds(instant)


def month_key(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def mentions(text: str | Column, word: str) -> Column:
    return F.lower(text).contains(word)


def normalise(value: str | Column, spellings: Mapping[str, str]) -> Column:
    """Map known spellings to one form and keep everything else.

    The table is a literal of the plan, so it belongs to short, fixed lists; a
    long list should be a table joined with ``attach``.
    """
    column = F.col(value) if isinstance(value, str) else value
    if not spellings:
        return column
    pairs = [F.lit(item) for pair in sorted(spellings.items()) for item in pair]
    return F.coalesce(F.create_map(*pairs)[column], column)


def violates_range(value: str | Column, low: float, high: float) -> Column:
    """True outside the closed range; null counts as no violation."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(~column.between(low, high), F.lit(False))
