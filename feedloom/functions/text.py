"""Text expressions: blanks, captures, names, hashes and JSON rendering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# An upline reads "Some Name - 12345".
UPLINE_CODE = r"-\s*([0-9]+)\s*\z"
UPLINE_TAIL = r"\s*-\s*[0-9]+\s*\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def empty_to_null(value: Column | str) -> Column:
    """'' becomes NULL; spaces are kept."""
    return F.nullif(_col(value).cast("string"), F.lit(""))


def blank_to_null(value: Column | str) -> Column:
    """Strip spaces (only spaces), then '' becomes NULL."""
    return F.nullif(F.trim(_col(value).cast("string")), F.lit(""))


def drop_float_tail(value: Column | str) -> Column:
    """``20260101.0`` becomes ``20260101``; blank becomes NULL."""
    return F.nullif(F.substring_index(_col(value).cast("string"), ".", 1), F.lit(""))


def capture(value: Column | str, pattern: str) -> Column:
    """First group of ``pattern``, NULL when it does not occur."""
    return F.nullif(F.regexp_extract(_col(value), pattern, 1), F.lit(""))


def zip_code(number: Column | str, text: Column | str | None = None) -> Column:
    """A text variant wins unchanged; a numeric zip is left-padded to five."""
    padded = F.lpad(_col(number).cast("string"), 5, "0")
    return padded if text is None else F.coalesce(empty_to_null(text), padded)


def basename(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def joined_name(*parts: Column | str) -> Column:
    """Non-blank parts joined by one space, NULL when all are blank."""
    return F.nullif(F.concat_ws(" ", *[blank_to_null(p) for p in parts]), F.lit(""))


def trailing_code(value: Column | str) -> Column:
    return capture(value, UPLINE_CODE)


def name_without_code(value: Column | str) -> Column:
    return F.nullif(F.trim(F.regexp_replace(_col(value), UPLINE_TAIL, "")), F.lit(""))


def json_text(value: Column) -> Column:
    """JSON with NULL fields written out, so an absent name stays a visible key."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def content_hash(columns: Sequence[Column | str]) -> Column:
    """Hash of the ordered values; NULL and '' give different hashes."""
    return F.md5(F.to_json(F.array(*[_col(c).cast("string") for c in columns])))


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality."""
    return ~left.eqNullSafe(right)
