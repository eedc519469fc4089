"""Latest-load views: pick the newest file, or the newest version per key, and enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.skew import lookup_join, top_per_key

# Fixed value: the ledger status of a file whose rows are stored.
LOADED = "loaded_to_postgres"


def any_like(name: Column, patterns: Sequence[str]) -> Column:
    """LIKE against several patterns; ``_`` matches any one character."""
    condition = F.lit(False)
    for p in patterns:
        condition = condition | name.like(p)
    return condition


def newest_loaded(ledger: DataFrame, provider: str, condition: Column) -> DataFrame:
    """The one ledger row of the newest loaded file that meets ``condition``."""
    return (
        ledger.filter((F.col("provider") == provider) & (F.col("status") == LOADED) & condition)
        .orderBy(F.col("landed_at").desc_nulls_first(), F.col("file_name").desc_nulls_first())
        .limit(1)
    )


def latest_file_by_ledger(ledger: DataFrame, provider: str, patterns: Sequence[str]) -> DataFrame:
    return newest_loaded(ledger, provider, any_like(F.col("file_name"), patterns)).select(
        F.col("file_name").alias("source_file")
    )


def latest_file_by_metadata(rows: DataFrame, newest: Sequence[str], file: str = "source_file") -> DataFrame:
    """The file with the greatest maxima of ``newest``, then the greatest name.

    Typed and raw tables pass different columns: typed also weighs the file date.
    """
    maxima = rows.groupBy(file).agg(*[F.max(c).alias(f"_m{i}") for i, c in enumerate(newest)])
    order = [F.col(f"_m{i}").desc_nulls_last() for i in range(len(newest))]
    return maxima.orderBy(*order, F.col(file).desc_nulls_first()).limit(1).select(file)


def rows_of_file(rows: DataFrame, latest: DataFrame, file: str = "source_file") -> DataFrame:
    """``latest`` comes from a limit(1), so broadcasting it is always safe."""
    return rows.join(F.broadcast(latest.select(file)), file, "left_semi")


def enrich(rows: DataFrame, key: str, *sides: DataFrame) -> DataFrame:
    """Left joins to side tables unique on ``key``."""
    for side in sides:
        rows = rows.join(side, key, "left")
    return rows


def latest_version(rows: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Newest row per key. ``newest`` is descending with NULL first; NULL keys group."""
    return top_per_key(rows, keys, [F.col(c).desc_nulls_first() for c in newest])


def latest_per_key_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a lookup that holds one row per key; hot keys are handled."""
    return lookup_join(rows, lookup, keys)
