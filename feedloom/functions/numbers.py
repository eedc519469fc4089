"""Guarded numeric casts: text that is not a plain number becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings.
UNSIGNED_INTEGER = r"^\d+\z"
NUMBER = r"^-?\d+(\.\d+)?\z"
SIGNED_NUMBER = r"^[+-]?\d+(\.\d+)?\z"

#: Widest decimal Spark offers for unbounded numerics.
NUMERIC = "decimal(38,10)"


def _guarded(value: Column, pattern: str, target: str) -> Column:
    return F.when(value.rlike(pattern), value.try_cast(target))


def safe_int(value: Column) -> Column:
    return _guarded(value, UNSIGNED_INTEGER, "int")


def safe_smallint(value: Column) -> Column:
    return _guarded(value, UNSIGNED_INTEGER, "smallint")


def safe_number(value: Column, plus_allowed: bool = False) -> Column:
    """``plus_allowed`` also takes a leading ``+``; without it such text is NULL."""
    return _guarded(value, SIGNED_NUMBER if plus_allowed else NUMBER, NUMERIC)
