"""Content-hashed versions of a snapshot that is replaced on each fetch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import content_hash
from feedloom.operators.merge import one_per_key, unseen


def hashed(snapshot: DataFrame, fields: Sequence[str], name: str = "row_hash") -> DataFrame:
    return snapshot.withColumn(name, content_hash(fields))


def new_versions(
    snapshot: DataFrame,
    canonical: DataFrame | None,
    fields: Sequence[str],
    source_id: str,
    first_seen: dt.datetime,
    name: str = "row_hash",
) -> DataFrame:
    """One row per content not stored yet, stamped with the run time.

    Among equal contents the lowest source id stays. The run time is an argument, so
    every row of a run carries the same instant and a retry repeats it.
    """
    kept = one_per_key(hashed(snapshot, fields, name), [name], [F.col(source_id).asc_nulls_last()])
    if canonical is not None:
        kept = unseen(kept, canonical, [name])
    return kept.withColumn("first_seen_at", F.lit(first_seen).cast("timestamp"))


def version_snapshot(
    snapshot: DataFrame, canonical: DataFrame, fields: Sequence[str], source_id: str, first_seen: dt.datetime
) -> DataFrame:
    """The canonical table after the snapshot."""
    added = new_versions(snapshot, canonical, fields, source_id, first_seen)
    return canonical.unionByName(added.select(*canonical.columns))
