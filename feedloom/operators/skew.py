"""Hot-group handling shared by the window and lookup jobs.

A window or a shuffled join sends every row of a key to one task. That is right for
ordinary keys and fatal for a key that owns a third of the data. The jobs here count
rows per key first (map-side combined, key columns only), keep ordinary keys on the
plain Spark operator, and give hot keys an exact path whose tasks are all bounded:

* lookups join the hot rows to the lookup rows of hot keys only, which are stored, so
  Spark knows their size: it broadcasts them if they are small, and else splits the skewed join;
* ordered scans cut a hot key into consecutive ranges of its own order, solve each
  range on its own, and carry a one-row summary from range to range.

Every key above ``feedloom.hotRows`` rows is split, however many there are. No rows are
dropped or sampled on either path, and no side is broadcast by force.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut, setting

#: Rows one key may hold before its window or join is split, and rows per range.
HOT_ROWS = ("feedloom.hotRows", 2_000_000)


@dataclass(frozen=True)
class Order:
    """One ascending sort column with an explicit place for NULL."""

    column: str
    nulls_first: bool = False

    @property
    def sort(self) -> Column:
        c = F.col(self.column)
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def as_order(columns: Sequence[str | Order]) -> tuple[Order, ...]:
    return tuple(c if isinstance(c, Order) else Order(c) for c in columns)


def order_struct(order: Sequence[Order]) -> Column:
    """The order as one comparable value, for ``max_by`` and friends."""
    fields = []
    for i, o in enumerate(order):
        if not o.nulls_first:  # structs compare NULL lowest, so flag it to the end
            fields.append(F.col(o.column).isNull().alias(f"n{i}"))
        fields.append(F.col(o.column).alias(f"v{i}"))
    return F.struct(*fields)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on null-safe equality of ``keys``, which appear once in the result.

    The right keys are renamed first so that a side derived from the other one
    cannot be confused with it.
    """
    renamed = {k: f"_right_{k}" for k in keys}
    right = right.select(*[F.col(c).alias(renamed.get(c, c)) for c in right.columns])
    condition = F.lit(True)
    for k, r in renamed.items():
        condition = condition & F.col(k).eqNullSafe(F.col(r))
    return left.join(right, condition, how).drop(*renamed.values())


def hot_keys(df: DataFrame, keys: Sequence[str], at_most: int | None = None) -> DataFrame | None:
    """The keys too large for one task with their row counts, stored, or None.

    An input of no more rows than one key may hold has no such key, which a plain count
    settles, or ``at_most``, a number of rows that the caller knows not to be exceeded. There are at most (rows / ``feedloom.hotRows``) of them, and none reaches the driver.
    """
    limit = setting(df.sparkSession, *HOT_ROWS)
    if at_most is not None and at_most <= limit or df.count() <= limit:
        return None
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    hot = cut(counted.filter(F.col("key_rows") > limit))
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, hot rows)."""
    few = hot.select(*keys)
    return null_safe_join(df, few, keys, "left_anti"), null_safe_join(df, few, keys, "left_semi")


# ------------------------------------------------------------------ lookups

def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", at_most: int | None = None
) -> DataFrame:
    """Join rows to a lookup that is unique on ``keys``; NULL keys match nothing.

    ``how`` is ``left`` or ``inner``. Hot keys meet their own lookup rows only, one per
    hot key; the rest is an ordinary join that Spark plans.
    """
    keys = list(keys)
    known = rows
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    hot = hot_keys(known.select(*keys), keys, at_most)
    if hot is None:
        return rows.join(lookup, keys, how)
    ordinary, frequent = split_hot(rows, hot, keys)
    few = cut(lookup.join(hot.select(*keys), keys, "left_semi"))
    return ordinary.join(lookup, keys, how).unionByName(frequent.join(few, keys, how))


# ------------------------------------------------------------ ordered scans

RANGE = "_range"


def ordered_ranges(hot_rows: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """Hot rows with the number of the consecutive range they fall in.

    Range partitioning on key and order cuts a large key at row boundaries. The
    partition number is only stable within one execution, so the result is stored.
    """
    total = hot.agg(F.sum("key_rows")).first()[0]
    pieces = max(2, math.ceil(total / setting(hot.sparkSession, *HOT_ROWS)) * 2)
    ranged = hot_rows.repartitionByRange(pieces, *[F.col(k) for k in keys], *[o.sort for o in order])
    return cut(ranged.withColumn(RANGE, F.spark_partition_id()))


def carry_in(
    ranged: DataFrame,
    keys: Sequence[str],
    summaries: Sequence[Column],
    carried: Callable[[object], Sequence[Column]],
) -> DataFrame:
    """Attach to each row what the earlier ranges of its key pass on.

    ``summaries`` aggregate one range; ``carried`` turns the window over the earlier
    ranges of the key into columns. There are at most (ranges + hot keys) summary
    rows, and a range is one task's work, so the join back is even.
    """
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy(*keys, RANGE).agg(*summaries)
    passed = cut(per_range.select(*keys, RANGE, *carried(earlier)))
    return null_safe_join(ranged, passed, [*keys, RANGE], "left")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Order], name: str) -> DataFrame:
    """``row_number`` per key that also holds when one key owns most rows."""
    order = as_order(order)
    sorts = [o.sort for o in order]
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*sorts)).cast("long")
    hot = hot_keys(df.select(*keys), keys)
    if hot is None:
        return df.withColumn(name, plain)
    ordinary, frequent = split_hot(df, hot, keys)
    ranged = ordered_ranges(frequent, hot, keys, order)
    offset = carry_in(
        ranged, keys,
        [F.count(F.lit(1)).alias("_n")],
        lambda w: [F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset")],
    )
    local = F.row_number().over(Window.partitionBy(*keys, RANGE).orderBy(*sorts))
    frequent_numbered = offset.withColumn(name, (local + F.col("_offset")).cast("long")).drop("_offset", RANGE)
    return ordinary.withColumn(name, plain).unionByName(frequent_numbered)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key. ``rank = 1`` lets Spark keep one row per key and map
    task before the shuffle (window group limit), so hot keys do not travel."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
