"""What a feed is: routes, typed columns, and the rules of its derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from feedloom.operators.episodes import EpisodeRule
from feedloom.operators.history import HistorySpec

#: Lineage columns of every raw row.
LINEAGE = ("source_file", "source_modified_at", "load_id", "row_id")

# Typed kinds.
TEXT = "text"                  # spaces stripped, blank is NULL
RAW = "raw"                    # as delivered
DATE = "date"                  # eight digits, spaces stripped first
DATE_AS_IS = "date_as_is"      # eight digits, not stripped
DATE_TAIL = "date_tail"        # eight digits, a ".0" tail is dropped
DATE_SLASH = "date_slash"      # MM/DD/YYYY
DATE_ANY = "date_any"          # four formats
INT = "int"
INT_AS_IS = "int_as_is"
SMALLINT = "smallint"
NUMBER = "number"
SIGNED = "signed"              # a leading + is allowed
ZIP = "zip"                    # text variant, else five-digit padding


#: Name under which a file's date text is at hand for ``TypedSpec.file_date``.
FILE_TEXT = "_file_text"


@dataclass(frozen=True)
class Col:
    """``target`` read from ``source`` (same name when not given)."""

    target: str
    kind: str = TEXT
    source: str | None = None

    @property
    def raw(self) -> str:
        return self.source or self.target


@dataclass(frozen=True)
class Route:
    """Files of one kind: where they are, how they are read, which table they fill.

    ``columns`` is the exact ordered header when the feed has a contract. ``keep_tokens``
    keeps ``NA`` and the empty string as text; otherwise the usual tokens are NULL.

    ``multiline`` files may have quoted line breaks, and one task reads each of them whole. Without
    it files of any size are split by line, and a line with an open quote fails the load. The
    route decides, never the size of a file. ``required`` are stored columns a file must have.
    """

    name: str
    glob: str
    table: str
    parser: str = "csv"
    columns: tuple[str, ...] | None = None
    keep_tokens: bool = False
    multiline: bool = True
    required: tuple[str, ...] = ()


@dataclass(frozen=True)
class TypedSpec:
    columns: tuple[Col, ...]
    file_text: Callable[[], Column] | None = None   # date text of the file name
    file_date: Callable[[], Column] | None = None   # its day, from FILE_TEXT and lineage
    risk: Callable[[], Column] | None = None
    optional: tuple[str, ...] = ()
    lineage: tuple[Col, ...] = ()
    row_number: str | None = None
    output: tuple[str, ...] | None = None


@dataclass(frozen=True)
class FeedSpec:
    name: str
    table: str
    routes: tuple[Route, ...]
    typed: TypedSpec
    key: str
    history: HistorySpec | None = None
    episodes: EpisodeRule | None = None
    carrier_pattern: str | None = None
    levels: tuple[str, ...] = ()
    file_patterns: tuple[str, ...] = ()
    newest_raw: tuple[str, ...] = ()
    newest_typed: tuple[str, ...] = ()
    view_columns: tuple[str, ...] | None = None
    side_tables: dict[str, TypedSpec] = field(default_factory=dict)

    @property
    def by_ledger(self) -> bool:
        return bool(self.file_patterns)
