"""File ledger, load verification, freshness and reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import basename
from feedloom.operators.latest import LOADED, newest_loaded
from feedloom.operators.merge import (
    KEEP_WHEN_NULL,
    TAKE_NEW,
    coalescing_upsert,
    either_key_unseen,
    insert_only,
)

# The life of a file, one ledger row per (source, target) pair.
COPIED, MOVED, ARCHIVED = "copied_to_landing", "moved_to_landing", "archived"
STATUSES = (COPIED, MOVED, LOADED, ARCHIVED)
LEDGER_KEY = ("provider", "source_path", "target_path")
LEDGER_SCHEMA = T.StructType([
    T.StructField("provider", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("target_path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
])
EVENT_SCHEMA = T.StructType([
    T.StructField("event_no", T.LongType()),
    *[f for f in LEDGER_SCHEMA.fields if f.name not in ("file_name", "landed_at")],
])
# The daily policy file and its age limit.
POLICY_FILE = r"^(UNL)?FYM_Policy_[0-9]{14}\.csv\z"
MAX_AGE = dt.timedelta(hours=30)


class MissingLoadError(RuntimeError):
    """Expected files have no stored rows."""


def record_files(events: DataFrame, ledger: DataFrame, now: dt.datetime) -> DataFrame:
    """The ledger after ``events``, which apply in ``event_no`` order.

    Status and error follow the last event; a NULL size never replaces a known one.
    """
    latest = F.col("event_no")
    known_size = F.when(F.col("file_size_bytes").isNotNull(), latest)
    per_file = events.groupBy(*LEDGER_KEY).agg(
        F.max_by("file_size_bytes", known_size).alias("file_size_bytes"),
        F.max_by("status", latest).alias("status"),
        F.max_by("error_message", latest).alias("error_message"),
    ).withColumns({
        "file_name": basename("target_path"),
        "landed_at": F.lit(now).cast("timestamp"),
    })
    rules = {"file_size_bytes": KEEP_WHEN_NULL, "status": TAKE_NEW, "error_message": TAKE_NEW}
    return coalescing_upsert(ledger, per_file, LEDGER_KEY, rules)


def resolved(events: DataFrame) -> DataFrame:
    """The ledger from all timed events: status and error of the last one, the last known size, times in order.

    Events apply by ``recorded_at``, then ``event_no``.
    """
    place = F.struct("recorded_at", "event_no", "status")
    known_size = F.when(F.col("file_size_bytes").isNotNull(), place)
    return events.groupBy(*LEDGER_KEY).agg(
        F.max_by("file_size_bytes", known_size).alias("file_size_bytes"),
        F.max_by("status", place).alias("status"), F.max_by("error_message", place).alias("error_message"),
        F.max("recorded_at").alias("landed_at"),
    ).withColumn("file_name", basename("target_path")).select(*LEDGER_SCHEMA.fieldNames())


def missing_loads(expected: DataFrame, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Expected (table_name, file_name) pairs without any stored row.

    Stored files are reduced to distinct names before they meet the expectation. A
    table that is not stored at all has no rows, so its files are all missing.
    """
    stored = None
    for table, rows in raw.items():
        names = rows.select(F.col("source_file").alias("file_name")).distinct()
        names = names.select(F.lit(table).alias("table_name"), "file_name")
        stored = names if stored is None else stored.unionByName(names)
    wanted = expected.select("table_name", "file_name").distinct()
    return wanted if stored is None else wanted.join(stored, ["table_name", "file_name"], "left_anti")


def require_loads(expected: DataFrame, raw: Mapping[str, DataFrame]) -> None:
    """Raise with every missing pair; the list is bounded by the files of one load."""
    gaps = missing_loads(expected, raw).orderBy("table_name", "file_name").collect()
    if gaps:
        listed = ", ".join(f"{g.table_name} <- {g.file_name}" for g in gaps)
        raise MissingLoadError(f"no stored rows for {listed}; files stay unmarked")


def freshness(
    ledger: DataFrame, provider: str, now: dt.datetime, pattern: str = POLICY_FILE, max_age: dt.timedelta = MAX_AGE
) -> DataFrame:
    """One row: is the newest loaded file found, and is it recent enough?"""
    newest = newest_loaded(ledger, provider, F.col("file_name").rlike(pattern))
    age = F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("landed_at")
    limit = int(max_age / dt.timedelta(microseconds=1))
    found = newest.select(
        "file_name", "status", "landed_at",
        (age / 1_000_000).alias("age_seconds"), (age <= limit).alias("is_recent"),
    )
    # A global aggregate yields its row even when nothing was found.
    return found.agg(
        (F.count(F.lit(1)) > 0).alias("found"),
        F.coalesce(F.max("is_recent"), F.lit(False)).alias("is_recent"),
        *[F.max(c).alias(c) for c in ("file_name", "status", "landed_at", "age_seconds")],
    )


def unmatched_rows(raw: DataFrame, typed: DataFrame, key: str = "row_id") -> DataFrame:
    """Raw rows without a typed row."""
    return raw.join(typed.select(key).distinct(), key, "left_anti")


def reconcile(raw: DataFrame, typed: DataFrame, key: str = "row_id") -> DataFrame:
    return unmatched_rows(raw, typed, key).agg(F.count(F.lit(1)).alias("missing_typed_rows"))


def repair_gap(source: DataFrame, typed: DataFrame) -> DataFrame:
    """The typed table with the source rows it lacks under both ids."""
    missing = either_key_unseen(source, typed, {"row_id": "row_id", "raw_row_id": "raw_row_id"})
    return insert_only(typed, missing, ["row_id"])
