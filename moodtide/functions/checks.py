"""Row checks: each is a column holding an error code, or NULL where the row passes (V1-V5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_null(value: Column, code: str) -> Column:
    return F.when(value.isNull(), F.lit(code))


def not_empty_string(value: Column, code: str) -> Column:
    """Null and ``''`` fail; blanks pass."""
    return F.when(value.isNull() | (value == ""), F.lit(code))


def not_empty_collection(value: Column, code: str) -> Column:
    """For arrays and maps: null and size 0 fail."""
    return F.when(value.isNull() | (F.size(value) == 0), F.lit(code))


def in_range(value: Column, low: float, high: float, code: str) -> Column:
    """Inclusive range. NaN passes: Spark sorts it above every number, hence the guard."""
    number = value.cast("double")
    return F.when((number < low) | ((number > high) & ~F.isnan(number)), F.lit(code))
