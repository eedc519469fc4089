"""Change history: for every observation, the last change seen so far.

One scan in observation order serves the full rebuild, the incremental run (each key
seeded by its last processed observation) and hot keys (each range seeded by the
ranges before it). Three rules exist for the reported date:

* ``running_max``  the latest day of any change so far;
* ``change_row``   the day of the change observation itself, possibly NULL;
* ``previous_row`` the day of the observation before the change.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.text import differs
from feedloom.operators.skew import (
    RANGE,
    Order,
    as_order,
    carry_in,
    hot_keys,
    null_safe_join,
    order_struct,
    ordered_ranges,
    split_hot,
)
from feedloom.session import cut

RUNNING_MAX, CHANGE_ROW, PREVIOUS_ROW = "running_max", "change_row", "previous_row"


@dataclass(frozen=True)
class Tracked:
    column: str
    previous_name: str
    date_name: str


@dataclass(frozen=True)
class HistorySpec:
    key: tuple[str, ...]
    order: tuple[str | Order, ...]
    row_id: str
    tracked: tuple[Tracked, ...]
    event_date: str = "file_date"
    date_rule: str = RUNNING_MAX

    @property
    def sorts(self) -> tuple[Order, ...]:
        return as_order(self.order)

    @property
    def output(self) -> list[str]:
        return [self.row_id, *[n for t in self.tracked for n in (t.previous_name, t.date_name)]]

    @property
    def inputs(self) -> list[str]:
        names = [*self.key, *[o.column for o in self.sorts], self.row_id, self.event_date]
        return list(dict.fromkeys([*names, *[t.column for t in self.tracked]]))


def _observation(spec: HistorySpec) -> Column:
    """What the next observation needs to know about this one."""
    return F.struct(
        *[F.col(t.column).alias(f"v{i}") for i, t in enumerate(spec.tracked)],
        F.col(spec.event_date).alias("day"),
    )


def _change(spec: HistorySpec, index: int, tracked: Tracked, seeded: bool) -> Column:
    """NULL, or the change this observation is: (previous value, reported day).

    A struct keeps a NULL previous value distinguishable from "no change".
    """
    previous = F.col("_before")
    day = previous["day"] if spec.date_rule == PREVIOUS_ROW else F.col(spec.event_date)
    change = F.when(
        previous.isNotNull() & differs(previous[f"v{index}"], F.col(tracked.column)),
        F.struct(previous[f"v{index}"].alias("previous"), day.alias("day")),
    )
    if not seeded:
        return change
    # A seed stands for everything processed before it and is always an event.
    seed = F.struct(F.col(f"_seed_previous{index}").alias("previous"), F.col(f"_seed_day{index}").alias("day"))
    return F.when(F.col("_is_seed"), seed).otherwise(change)


def _scan(rows: DataFrame, spec: HistorySpec, seeded: bool, ranged: bool, kept: Sequence[str]) -> DataFrame:
    """Resolve rows whose window is ``key`` or, for hot keys, (key, range). The columns ``kept`` stay beside the result."""
    group = [*spec.key, RANGE] if ranged else list(spec.key)
    in_order = Window.partitionBy(*group).orderBy(*[o.sort for o in spec.sorts])
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    before = F.lag(_observation(spec)).over(in_order)
    if ranged:
        rows = carry_in(
            rows, spec.key,
            [F.max_by(_observation(spec), order_struct(spec.sorts)).alias("_last")],
            lambda w: [F.last("_last").over(w).alias("_carried")],
        )
        before = F.coalesce(before, F.col("_carried"))
    rows = rows.withColumn("_before", before).drop("_carried")
    changes = {f"_change{i}": _change(spec, i, t, seeded) for i, t in enumerate(spec.tracked)}
    rows = rows.withColumns(changes)

    names = list(changes)
    if ranged:
        ordering = order_struct(spec.sorts)
        rows = carry_in(
            rows, spec.key,
            [
                *[F.max_by(n, F.when(F.col(n).isNotNull(), ordering)).alias(f"_last{n}") for n in names],
                *[F.max(F.col(n)["day"]).alias(f"_max{n}") for n in names],
            ],
            lambda w: [
                *[F.last(f"_last{n}", ignorenulls=True).over(w).alias(f"_from{n}") for n in names],
                *[F.max(f"_max{n}").over(w).alias(f"_day{n}") for n in names],
            ],
        )

    result = []
    for n, t in zip(names, spec.tracked):
        latest = F.last(n, ignorenulls=True).over(so_far)
        newest_day = F.max(F.col(n)["day"]).over(so_far)
        if ranged:
            latest = F.coalesce(latest, F.col(f"_from{n}"))
            newest_day = F.greatest(newest_day, F.col(f"_day{n}"))
        day = newest_day if spec.date_rule == RUNNING_MAX else latest["day"]
        result += [latest["previous"].alias(t.previous_name), day.alias(t.date_name)]
    return rows.select(*kept, *result, *(["_is_seed"] if seeded else []))


def _history(rows: DataFrame, spec: HistorySpec, seeded: bool, at_most: int | None, kept: Sequence[str] = ()) -> DataFrame:
    kept = kept or [spec.row_id]
    hot = hot_keys(rows.select(*spec.key), spec.key, at_most)
    if hot is None:
        return _scan(rows, spec, seeded, False, kept)
    ordinary, frequent = split_hot(rows, hot, spec.key)
    ranged = ordered_ranges(frequent, hot, spec.key, spec.sorts)
    return _scan(ordinary, spec, seeded, False, kept).unionByName(_scan(ranged, spec, seeded, True, kept))


def change_history(typed: DataFrame, spec: HistorySpec, at_most: int | None = None) -> DataFrame:
    """Full rebuild: one row per observation. ``at_most`` is a number of rows known not to be exceeded."""
    return _history(typed.select(*spec.inputs), spec, seeded=False, at_most=at_most)


def pending_rows(typed: DataFrame, history: DataFrame, spec: HistorySpec) -> DataFrame:
    """Observations without a history row."""
    return typed.join(history.select(spec.row_id), spec.row_id, "left_anti")


def tails(typed: DataFrame, history: DataFrame, spec: HistorySpec) -> DataFrame:
    """One row per key: the last processed observation with its history values, and the
    newest processed day. "Last" is the order of the history, NULL days included.

    This is all an incremental run needs to know about the past, so a flow keeps it
    stored and its cost follows the new rows and the number of keys, not the history.
    """
    done = typed.select(*spec.inputs).join(history.select(*spec.output), spec.row_id)
    return newest_tails(done.withColumn("newest_day", F.col(spec.event_date)), spec)


def rebuilt_tails(typed: DataFrame, spec: HistorySpec, at_most: int | None = None) -> DataFrame:
    """The tails after a full rebuild, from a scan of their own: rows and their history meet in the window of
    their key, so neither is shuffled by row id, and the last of each key is found where the window left it."""
    done = _history(typed.select(*spec.inputs), spec, False, at_most, spec.inputs)
    return newest_tails(done.withColumn("newest_day", F.col(spec.event_date)), spec)


def newest_tails(candidates: DataFrame, spec: HistorySpec) -> DataFrame:
    """The last candidate of each key and the newest day over all of them, in one
    aggregation that reduces before the shuffle."""
    columns = [*spec.inputs, *[c for c in spec.output if c not in spec.inputs]]
    reduced = candidates.groupBy(*[F.col(k).alias(f"_key_{k}") for k in spec.key]).agg(
        F.max_by(F.struct(*columns), order_struct(spec.sorts)).alias("_last"),
        F.max("newest_day").alias("newest_day"),
    )
    return reduced.select("_last.*", "newest_day")


def advanced_tails(stored: DataFrame, pending: DataFrame, added: DataFrame, spec: HistorySpec) -> DataFrame:
    """Tails after the pending rows got their history rows ``added``."""
    fresh = pending.select(*spec.inputs).join(added, spec.row_id).withColumn("newest_day", F.col(spec.event_date))
    return newest_tails(stored.unionByName(fresh.select(*stored.columns)), spec)


def extend_history(pending: DataFrame, past: DataFrame, spec: HistorySpec, at_most: int | None = None) -> DataFrame:
    """History rows of the pending observations, each key seeded by its tail.

    Keys whose pending rows are not all later than their tail must be recomputed
    instead, see ``late_keys``.
    """
    affected = pending.select(*spec.key).distinct()
    seeds = null_safe_join(past, affected, spec.key, "left_semi")
    types = pending.schema
    blank = {f"_seed_previous{i}": F.lit(None).cast(types[t.column].dataType) for i, t in enumerate(spec.tracked)}
    blank |= {f"_seed_day{i}": F.lit(None).cast("date") for i in range(len(spec.tracked))}
    known = {f"_seed_previous{i}": F.col(t.previous_name) for i, t in enumerate(spec.tracked)}
    known |= {f"_seed_day{i}": F.col(t.date_name) for i, t in enumerate(spec.tracked)}
    rows = seeds.withColumns(known).select(*spec.inputs, *known, F.lit(True).alias("_is_seed")).unionByName(
        pending.withColumns(blank).select(*spec.inputs, *blank, F.lit(False).alias("_is_seed"))
    )
    return _history(rows, spec, seeded=True, at_most=at_most).filter(~F.col("_is_seed")).drop("_is_seed")


def late_keys(pending: DataFrame, past: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys with a pending row that cannot just follow their tail.

    That is a first pending day not after the newest processed day, or a first pending row
    that sorts before the tail. The second covers NULL days, which the order places at one end.
    """
    first = pending.groupBy(*spec.key).agg(
        F.min(spec.event_date).alias("first_pending"), F.min(order_struct(spec.sorts)).alias("_first"),
    )
    known = past.select(*spec.key, "newest_day", order_struct(spec.sorts).alias("_tail"))
    late = (F.col("first_pending") <= F.col("newest_day")) | _before(spec)
    return null_safe_join(first, known, spec.key, "inner").filter(late).drop("_first", "_tail")


def _before(spec: HistorySpec) -> Column:
    """Whether ``_first`` sorts before ``_tail``; both are order structs, whose comparison is never NULL."""
    return F.struct("_first", F.lit(0)) < F.struct("_tail", F.lit(0))


def incremental_history(typed: DataFrame, history: DataFrame, spec: HistorySpec) -> DataFrame:
    """History rows for the pending observations only.

    Keys with late pending rows must have been cleared by ``out_of_order_reset``.
    """
    observed = typed.select(*spec.inputs)
    return extend_history(pending_rows(observed, history, spec), tails(observed, history, spec), spec)


def out_of_order_keys(typed: DataFrame, history: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys whose first pending row does not follow their last processed row, by day or by order.

    One flagged pass and one combined aggregation. A NULL key is a group like any other. The
    bounds are the days; NULL days count through the order only.
    """
    done = history.select(spec.row_id, F.lit(True).alias("_done"))
    needed = list(dict.fromkeys([*spec.key, *[o.column for o in spec.sorts], spec.row_id, spec.event_date]))
    flagged = typed.select(*needed).join(done, spec.row_id, "left")
    day, place = F.col(spec.event_date), order_struct(spec.sorts)
    bounds = flagged.groupBy(*spec.key).agg(
        F.min(F.when(F.col("_done").isNull(), day)).alias("first_pending"),
        F.max(F.when(F.col("_done"), day)).alias("last_processed"),
        F.min(F.when(F.col("_done").isNull(), place)).alias("_first"),
        F.max(F.when(F.col("_done"), place)).alias("_tail"),
    )
    both = F.col("_first").isNotNull() & F.col("_tail").isNotNull()
    late = (F.col("first_pending") <= F.col("last_processed")) | (both & _before(spec))
    return bounds.filter(late).drop("_first", "_tail")


def without_keys(history: DataFrame, typed: DataFrame, late: DataFrame, spec: HistorySpec) -> DataFrame:
    """History rows of all other keys."""
    observed = typed.select(*spec.key, spec.row_id)
    doomed = null_safe_join(observed, late.select(*spec.key), spec.key, "left_semi").select(spec.row_id)
    return history.join(doomed, spec.row_id, "left_anti")


def out_of_order_reset(typed: DataFrame, history: DataFrame, spec: HistorySpec) -> DataFrame:
    """History without the rows of out-of-order keys, which then become pending."""
    return without_keys(history, typed, out_of_order_keys(typed, history, spec), spec)


def refreshed_history(
    typed: DataFrame, history: DataFrame, spec: HistorySpec,
    pending: DataFrame | None = None, past: DataFrame | None = None, late: DataFrame | None = None,
) -> DataFrame:
    """Existing history, repaired where files came late, plus the pending rows.

    Late keys are computed again from all their rows, the others are extended from
    their tails. ``pending`` and ``past`` are derived when not at hand.
    """
    observed = typed.select(*spec.inputs)
    number = observed.count()
    pending = cut(pending_rows(observed, history, spec)) if pending is None else pending
    past = cut(tails(observed, history, spec)) if past is None else past
    late = cut(late_keys(pending, past, spec).select(*spec.key)) if late is None else late
    rebuilt = change_history(null_safe_join(observed, late, spec.key, "left_semi"), spec, number)
    in_order = null_safe_join(pending.select(*spec.inputs), late, spec.key, "left_anti")
    return (
        without_keys(history, observed, late, spec).select(*spec.output)
        .unionByName(rebuilt).unionByName(extend_history(in_order, past, spec, 2 * number))
    )


def correct_and_append(existing: DataFrame, computed: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Existing rows take recomputed values where these differ, new rows are added."""
    from feedloom.operators.merge import correct_changed, insert_only

    corrected = correct_changed(existing, computed, [key], values).drop("_changed")
    return insert_only(corrected, computed, [key])
