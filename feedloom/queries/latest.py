"""Latest-load selections and their enriched views."""

from pyspark.sql import functions as F

from feedloom.operators import history as h
from feedloom.operators import latest as lt
from feedloom.operators.episodes import POLICY_RULE, risk_episodes
from feedloom.plans.feeds import unl
from feedloom.queries import texts as x
from feedloom.queries.changes import changes_sql
from feedloom.queries.episodes import episodes_from
from feedloom.queries.registry import query, table
from feedloom.queries.typing import policy_sql, stored_policies, unl_policies


@query("latest_per_key", """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
    WHERE n = 1""")
def latest_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return lt.latest_version(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("latest_load_meta", """
    WITH files AS (
        SELECT concat(event_type, '.csv') AS source_file, event_id,
               CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE CAST(ts AS DATE) END AS modified FROM events
    ),
    newest AS (
        SELECT source_file FROM files GROUP BY source_file
        ORDER BY max(modified) DESC NULLS LAST, max(event_id // 100) DESC NULLS LAST, source_file DESC LIMIT 1
    )
    SELECT event_id, source_file FROM files WHERE source_file IN (SELECT source_file FROM newest)""")
def latest_load_meta(spark, sf_dir):
    """Files are event types; two of them have no modification time."""
    files = table(spark, sf_dir, "events").select(
        "event_id", F.concat("event_type", F.lit(".csv")).alias("source_file"),
        F.when(~F.col("event_type").isin("view", "error"), F.to_date("ts")).alias("modified"),
        F.floor(F.col("event_id") / 100).alias("load"),
    )
    newest = lt.latest_file_by_metadata(files, ["modified", "load"])
    return lt.rows_of_file(files, newest).select("event_id", "source_file")


def file_ledger(spark, sf_dir):
    """Every order day is a file; only files of finished orders count as loaded."""
    return table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.max(F.col("o_orderstatus") == "F").alias("loaded")
    ).select(
        F.lit("unl").alias("provider"),
        F.concat(F.lit("UNLFYM_Policy_"), F.date_format("day", "yyyyMMdd"), F.lit("060000.csv")).alias("file_name"),
        F.when(F.col("loaded"), lt.LOADED).otherwise("moved_to_landing").alias("status"),
        F.col("day").cast("timestamp").alias("landed_at"),
    )


NEWEST_FILE = """(SELECT concat('UNLFYM_Policy_', strftime(max(o_orderdate), '%Y%m%d'), '060000.csv')
    FROM orders WHERE o_orderstatus = 'F')"""


@query("latest_load_audit", f"""
    SELECT policy_nbr, row_id, source_file FROM {x.derived_sql(x.POLICY_TEXT)} WHERE source_file = {NEWEST_FILE}""")
def latest_load_audit(spark, sf_dir):
    rows = x.derived(spark, sf_dir, x.POLICY_TEXT).select("policy_nbr", "row_id", "source_file")
    return lt.rows_of_file(rows, lt.latest_file_by_ledger(file_ledger(spark, sf_dir), "unl", unl.FILE_PATTERNS))


POLICY_HISTORY_SQL = changes_sql(
    f"""SELECT *, file_date AS day, strftime(coalesce(file_date, DATE '9999-01-01'), '%Y%m%d') || row_id AS place
        FROM ({policy_sql(x.POLICY_TEXT, trimmed=False)})""",
    "policy_nbr", "row_id", [
        ("cntrct_code", "previous_contract_code", "contract_code_last_change_date"),
        ("at_risk_policy", "previous_at_risk_status", "at_risk_status_last_change_date"),
    ],
)


@query("policy_change_history", f"WITH {POLICY_HISTORY_SQL} SELECT * FROM history")
def policy_change_history(spark, sf_dir):
    """Text to typed to history in one plan."""
    return h.change_history(unl_policies(spark, sf_dir), unl.HISTORY)


@query("latest_enriched", f"""
    WITH {POLICY_HISTORY_SQL}
    SELECT t.policy_nbr, t.row_id, t.cntrct_code, t.file_date, 'unl' AS carrier, h.* EXCLUDE (row_id)
    FROM seen t LEFT JOIN history h USING (row_id)
    WHERE t.file_date = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'F')""")
def latest_enriched(spark, sf_dir):
    policies = unl_policies(spark, sf_dir)
    newest = lt.latest_file_by_ledger(file_ledger(spark, sf_dir), "unl", unl.FILE_PATTERNS)
    current = lt.rows_of_file(policies, newest).select("policy_nbr", "row_id", "cntrct_code", "file_date")
    history = h.change_history(policies, unl.HISTORY)
    return lt.enrich(current.withColumn("carrier", F.lit("unl")), "row_id", history)


POLICY_DAYS = f"""
    SELECT policy_nbr, file_date AS day, at_risk_policy AS risky, paid_to_date >= file_date AS cures, cntrct_code = 'T' AS ends
    FROM ({policy_sql(x.POLICY_TEXT, trimmed=False)})"""


@query("policy_risk_episodes", episodes_from(POLICY_DAYS, "policy_nbr", 7))
def policy_episodes(spark, sf_dir):
    return risk_episodes(stored_policies(spark, sf_dir), "policy_nbr", POLICY_RULE)
