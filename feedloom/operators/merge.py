"""Idempotent write semantics as joins. Each returns the new table content."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import differs
from feedloom.operators.skew import top_per_key

KEEP_WHEN_NULL, TAKE_NEW = "keep_when_null", "take_new"


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table with a query's schema, so a first run equals later runs."""
    return spark.createDataFrame([], schema)


def one_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] | None = None) -> DataFrame:
    """Deduplicate incoming rows before a merge. ``prefer`` must be a total order
    within a key, otherwise all remaining columns break ties."""
    order = prefer or [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return top_per_key(df, keys, order or [F.lit(0)])


def unseen(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet; ``existing`` holds a key once."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")


def insert_only(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], prefer: Sequence[Column] | None = None
) -> DataFrame:
    """Existing rows untouched; one row added per new key.

    Deduplication comes first: it keeps one row per key and map task, so copies of one
    key never meet in the anti join, which then reuses its partitioning.
    """
    added = unseen(one_per_key(incoming, keys, prefer), existing, keys)
    return existing.unionByName(added.select(*existing.columns))


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], prefer: Sequence[Column] | None = None
) -> DataFrame:
    """Incoming rows replace rows of the same key."""
    fresh = one_per_key(incoming, keys, prefer).select(*existing.columns)
    return unseen(existing, fresh, keys).unionByName(fresh)


def coalescing_upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], rules: Mapping[str, str],
    prefer: Sequence[Column] | None = None,
) -> DataFrame:
    """Upsert with a rule per column: take the new value, or keep the old one when
    the new one is NULL."""
    keys = list(keys)
    fresh = one_per_key(incoming, keys, prefer).select(*existing.columns)
    kept = [c for c in existing.columns if rules.get(c) == KEEP_WHEN_NULL]
    old = existing.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in kept])
    merged = fresh.join(old, keys, "left").select(
        *[F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) if c in kept else F.col(c) for c in existing.columns]
    )
    return unseen(existing, fresh, keys).unionByName(merged)


def delete_missing(existing: DataFrame, refreshed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys are made distinct first, which happens before the shuffle: a key repeated
    without end would otherwise gather in one task. The same holds below."""
    return existing.join(refreshed.select(*keys).distinct(), list(keys), "left_semi")


def delete_keys(existing: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return existing.join(doomed.select(*keys).distinct(), list(keys), "left_anti")


def mirror(
    existing: DataFrame, refreshed: DataFrame, keys: Sequence[str], prefer: Sequence[Column] | None = None
) -> DataFrame:
    """Upsert then delete what is missing: the target follows the refreshed set.

    Columns the refreshed set does not carry keep their stored value.
    """
    keys = list(keys)
    fresh = one_per_key(refreshed, keys, prefer)
    stored_only = [c for c in existing.columns if c not in refreshed.columns]
    if not stored_only:
        return fresh.select(*existing.columns)
    return fresh.join(existing.select(*keys, *stored_only), keys, "left").select(*existing.columns)


def correct_changed(existing: DataFrame, computed: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Update only where a value differs (null-safe). ``_changed`` marks such rows;
    keys without a computed row keep their values."""
    keys = list(keys)
    new = computed.select(*keys, F.lit(True).alias("_found"), *[F.col(v).alias(f"_new_{v}") for v in values])
    joined = existing.join(new, keys, "left")
    changed = F.lit(False)
    for v in values:
        changed = changed | differs(F.col(v), F.col(f"_new_{v}"))
    changed = F.coalesce(F.col("_found"), F.lit(False)) & changed
    updated = [
        F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in existing.columns
    ]
    return joined.select(*updated, changed.alias("_changed"))


def either_key_unseen(source: DataFrame, existing: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Source rows matching existing rows on none of the key pairs.

    One anti join per pair: an OR condition would fall back to a nested loop.
    """
    remaining = source
    for source_key, existing_key in keys.items():
        known = existing.select(F.col(existing_key).alias(source_key)).filter(F.col(source_key).isNotNull())
        remaining = remaining.join(known.distinct(), source_key, "left_anti")
    return remaining
