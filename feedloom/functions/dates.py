"""Guarded date parsing: text that is not an existing day becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shapes.
COMPACT = r"^\d{8}\z"
ISO = r"^\d{4}-\d{2}-\d{2}\z"
SLASH = r"^\d{2}/\d{2}/\d{4}\z"
LOOSE_SLASH = r"^\d{1,2}/\d{1,2}/\d{4}\z"
LOOSE_DASH = r"^\d{1,2}-\d{1,2}-\d{4}\z"
NO_YEAR = "0000"

# Fixed value: a load id is the epoch second of the load, with a fraction.
LOAD_ID = r"^\d+(\.\d+)?\z"


def _day(year: Column, month: Column, day: Column) -> Column:
    """The day if the calendar has it.

    A cast of ISO text answers NULL for an impossible day. A pattern parser would raise
    and catch an exception per bad value, which sentinels like ``00000000`` make common.
    """
    return F.when(year != NO_YEAR, F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date"))


def _iso(value: Column) -> Column:
    return F.when(F.substring(value, 1, 4) != NO_YEAR, value.try_cast("date"))


def _compact(value: Column) -> Column:
    return _day(F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))


def _month_first(value: Column, separator: str) -> Column:
    month_day = F.substring_index(value, separator, 2)
    return _day(
        F.right(value, F.lit(4)), F.substring_index(month_day, separator, 1), F.substring_index(month_day, separator, -1)
    )


def date_compact(value: Column) -> Column:
    """Eight digits; ``00000000`` and impossible days are NULL."""
    return F.when(value.rlike(COMPACT), _compact(value))


def date_slash(value: Column) -> Column:
    """Strict two-digit month and day."""
    return F.when(value.rlike(SLASH), _month_first(value, "/"))


def date_any(value: Column) -> Column:
    """ISO, compact, ``M/D/YYYY`` or ``M-D-YYYY``; a text has one of these shapes at most."""
    return (
        F.when(value.rlike(ISO), _iso(value))
        .when(value.rlike(COMPACT), _compact(value))
        .when(value.rlike(LOOSE_SLASH), _month_first(value, "/"))
        .when(value.rlike(LOOSE_DASH), _month_first(value, "-"))
    )


def utc_date(moment: Column) -> Column:
    """The UTC calendar day whatever the session zone is."""
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz")))


def epoch_date(load_id: Column) -> Column:
    """Day of a load id holding epoch seconds."""
    seconds = F.when(load_id.rlike(LOAD_ID), load_id.try_cast("double"))
    return utc_date(F.timestamp_seconds(seconds))


def file_date_chain(*candidates: Column) -> Column:
    """First known day among name, modification time and load id."""
    return F.coalesce(*candidates)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)
