"""Change histories under the three date rules, in full, incremental and repaired."""

from dataclasses import replace

from pyspark.sql import functions as F

from feedloom.operators import history as h
from feedloom.operators.skew import numbered
from feedloom.queries.changes import CHANGE_ROW, PREVIOUS_ROW, changes_sql, event_place
from feedloom.queries.registry import query, table
from feedloom.session import cut

EVENT_HISTORY = h.HistorySpec(
    key=("user_id",), order=("ts", "event_id"), row_id="event_id", event_date="day",
    tracked=(
        h.Tracked("kind", "previous_kind", "kind_changed"),
        h.Tracked("big", "previous_big", "big_changed"),
    ),
)
KINDS = (("kind", "previous_kind", "kind_changed"), ("big", "previous_big", "big_changed"))
SEEN_EVENTS = """
    SELECT event_id, user_id, {day} AS day, nullif(event_type, 'view') AS kind, value > 30 AS big, {place} FROM events"""


def event_history_sql(day: str, place: str) -> str:
    return f"WITH {changes_sql(SEEN_EVENTS.format(day=day, place=place), 'user_id', 'event_id', KINDS)} SELECT * FROM history"


EVENT_HISTORY_SQL = event_history_sql("CAST(ts AS DATE)", event_place())


def observed_events(spark, sf_dir):
    """Views count as an unknown kind, so changes to and from NULL occur."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.to_date("ts").alias("day"),
        F.nullif("event_type", F.lit("view")).alias("kind"), (F.col("value") > 30).alias("big"),
    )


@query("change_history", EVENT_HISTORY_SQL)
def change_history(spark, sf_dir):
    return h.change_history(observed_events(spark, sf_dir), EVENT_HISTORY)


@query("incremental_history", EVENT_HISTORY_SQL)
def incremental_history(spark, sf_dir):
    """The first half of the month is processed, the rest is added."""
    events = observed_events(spark, sf_dir)
    done = cut(h.change_history(events.filter(F.col("ts") < "2024-01-16"), EVENT_HISTORY))
    return done.unionByName(h.incremental_history(events, done, EVENT_HISTORY))


def processed_first(spark, sf_dir):
    """Even days are processed before the odd days arrive."""
    events = observed_events(spark, sf_dir)
    return events, cut(h.change_history(events.filter(F.dayofmonth("ts") % 2 == 0), EVENT_HISTORY))


@query("out_of_order_keys", """
    SELECT user_id, first_pending, last_processed FROM (
        SELECT user_id, min(CAST(ts AS DATE)) FILTER (WHERE day(ts) % 2 = 1) AS first_pending,
               max(CAST(ts AS DATE)) FILTER (WHERE day(ts) % 2 = 0) AS last_processed
        FROM events GROUP BY user_id)
    WHERE first_pending <= last_processed""")
def out_of_order_keys(spark, sf_dir):
    return h.out_of_order_keys(*processed_first(spark, sf_dir), EVENT_HISTORY)


@query("history_after_repair", EVENT_HISTORY_SQL)
def history_after_repair(spark, sf_dir):
    return h.refreshed_history(*processed_first(spark, sf_dir), EVENT_HISTORY)


UNDATED = "event_id % 9 = 4"


DATED = f"CASE WHEN {UNDATED} THEN NULL ELSE CAST(ts AS DATE) END"


@query("incremental_history_null_days", event_history_sql(DATED, event_place(f"coalesce({DATED}, DATE '9999-01-01')")))
def incremental_history_null_days(spark, sf_dir):
    """Every ninth event has no day; they arrive with the first and the last of three loads."""
    spec = replace(EVENT_HISTORY, order=("day", "event_id"))
    events = observed_events(spark, sf_dir).withColumn("day", F.when(~F.expr(UNDATED), F.col("day")))
    load = F.when(F.col("day").isNull(), F.col("event_id") % 2 * 2).otherwise(F.floor(F.dayofmonth("day") / 11))
    events = cut(events.withColumn("load", load))
    stored = cut(h.change_history(events.filter("load = 0"), spec))
    for upto in (1, 2):
        stored = cut(h.refreshed_history(events.filter(F.col("load") <= upto), stored, spec))
    return stored


ORDER_CHANGES = changes_sql(
    f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, {event_place('o_orderdate', 'o_orderkey')} FROM orders",
    "o_custkey", "o_orderkey", [("o_orderstatus", "previous_status", "status_changed")], CHANGE_ROW,
)


@query("change_row_history", f"WITH {ORDER_CHANGES} SELECT * FROM history")
def change_row_history(spark, sf_dir):
    spec = h.HistorySpec(
        key=("o_custkey",), order=("o_orderdate", "o_orderkey"), row_id="o_orderkey", event_date="day",
        date_rule=h.CHANGE_ROW, tracked=(h.Tracked("o_orderstatus", "previous_status", "status_changed"),),
    )
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return h.change_history(orders, spec)


STATUS_SPEC = h.HistorySpec(
    key=("user_id",), order=("ts", "event_id"), row_id="event_id", event_date="day",
    date_rule=h.PREVIOUS_ROW, tracked=(h.Tracked("event_type", "previous_status", "previous_status_date"),),
)
STATUS_CHANGES = changes_sql(
    f"SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, {event_place()} FROM events",
    "user_id", "event_id", [("event_type", "previous_status", "previous_status_date")], PREVIOUS_ROW,
)
STATUS_SQL = f"WITH {STATUS_CHANGES} SELECT * FROM history"


@query("status_prev_date", STATUS_SQL)
def status_prev_date(spark, sf_dir):
    return h.change_history(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), STATUS_SPEC)


@query("status_correct_and_append", STATUS_SQL)
def status_correct_and_append(spark, sf_dir):
    """Stored history lacks the errors, so later rows are corrected and errors added."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    stored = h.change_history(events.filter("event_type <> 'error'"), STATUS_SPEC)
    computed = h.change_history(events, STATUS_SPEC)
    return h.correct_and_append(stored, computed, "event_id", ["previous_status", "previous_status_date"])


ROLE_CHANGES = changes_sql(
    "SELECT {'conv_id': conv_id, 'turn': turn} AS id, conv_id, turn, role, turn AS place, CAST(NULL AS DATE) AS day FROM conversations",
    "conv_id", "id", [("role", "previous_role", "role_changed")],
)


@query("role_history", f"WITH {ROLE_CHANGES} SELECT id.conv_id AS conv_id, id.turn AS turn, previous_role FROM history")
def role_history(spark, sf_dir):
    spec = h.HistorySpec(
        key=("conv_id",), order=("turn",), row_id="row_id", event_date="day",
        tracked=(h.Tracked("role", "previous_role", "role_changed"),),
    )
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.lit(None).cast("date").alias("day"),
        F.struct("conv_id", "turn").alias("row_id"),
    )
    return h.change_history(rows, spec).select("row_id.conv_id", "row_id.turn", "previous_role")


@query("row_number_per_file", """
    SELECT event_id, event_type AS source_file,
           row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS row_number FROM events""")
def row_number_per_file(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("source_file"))
    return numbered(events, ["source_file"], ["event_id"], "row_number")
