"""SQL that says what a change history means, for comparison with the operator."""

from __future__ import annotations

from collections.abc import Sequence

#: Reported day: the latest of all changes, that of the change itself, or that of the row before it.
RUNNING_MAX, CHANGE_ROW, PREVIOUS_ROW = (
    "max(m.day) FILTER (WHERE {moved})",
    "(arg_max({{'v': m.day}}, m.place) FILTER (WHERE {moved})).v",
    "(arg_max({{'v': m.day_before}}, m.place) FILTER (WHERE {moved})).v",
)


def changes_sql(seen: str, key: str, row: str, tracked: Sequence[tuple[str, str, str]], rule: str = RUNNING_MAX) -> str:
    """CTEs ``seen``, ``moves`` and ``history`` over ``seen``, a query with a key, a row id, ``place``, ``day`` and the tracked columns.

    ``place`` is one value that orders a key's rows. A row moves if the row with the next smaller place of its key differs; its
    history is told by the rows of its key up to its own place that moved. ``tracked`` has column, name of the previous value, name of the day.
    """
    moves = ", ".join(f"b.{c} AS {c}_was, b.{c} IS DISTINCT FROM n.{c} AS {c}_moved" for c, _, _ in tracked)
    told = ", ".join(
        f"(arg_max({{'v': m.{c}_was}}, m.place) FILTER (WHERE m.{c}_moved)).v AS {before}, {rule.format(moved=f'm.{c}_moved')} AS {day}"
        for c, before, day in tracked
    )
    return f"""
    seen AS ({seen}),
    nearest AS (
        SELECT n.{row} AS id, max(o.place) AS place_before
        FROM seen n JOIN seen o ON o.{key} IS NOT DISTINCT FROM n.{key} AND o.place < n.place GROUP BY n.{row}
    ),
    moves AS (
        SELECT n.{key} AS k, n.place, n.day, b.day AS day_before, {moves}
        FROM nearest p JOIN seen n ON n.{row} = p.id JOIN seen b ON b.{key} IS NOT DISTINCT FROM n.{key} AND b.place = p.place_before
    ),
    history AS (
        SELECT n.{row}, {told}
        FROM seen n LEFT JOIN moves m ON m.k IS NOT DISTINCT FROM n.{key} AND m.place <= n.place GROUP BY n.{row}
    )"""


def event_place(at: str = "ts", tie: str = "event_id") -> str:
    return f"CAST(epoch_us(CAST({at} AS TIMESTAMP)) AS HUGEINT) * 1000000000000 + {tie} AS place"
