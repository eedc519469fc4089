"""Verification, freshness, reconciliation and report manifests."""

import datetime as dt

from pyspark.sql import functions as F

from feedloom.operators import audit
from feedloom.queries.registry import query, table
from feedloom.session import scratch_path
from feedloom.sinks import export


@query("verify_loads", """
    SELECT 'lines' AS table_name, concat('order_', o_orderkey, '.csv') AS file_name FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def verify_loads(spark, sf_dir):
    """Every order is an expected file of line items."""
    def name(key):
        return F.concat(F.lit("order_"), F.col(key).cast("string"), F.lit(".csv"))

    expected = table(spark, sf_dir, "orders").select(
        F.lit("lines").alias("table_name"), name("o_orderkey").alias("file_name")
    )
    lines = table(spark, sf_dir, "lineitem").select(name("l_orderkey").alias("source_file"))
    return audit.missing_loads(expected, {"lines": lines})


@query("reconcile", """
    SELECT count(*) AS missing_typed_rows FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def reconcile(spark, sf_dir):
    return audit.reconcile(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id")),
        table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("row_id")),
    )


FRESH_SQL = """
    WITH loaded AS (
        SELECT concat('UNLFYM_Policy_', strftime(ts, '%Y%m%d%H%M%S'), '.csv') AS file_name, ts AS landed_at
        FROM events WHERE event_type = 'purchase' AND value < 100
    ),
    newest AS (SELECT * FROM loaded ORDER BY landed_at DESC, file_name DESC LIMIT 1)
    SELECT count(*) > 0 AS found,
           coalesce(bool_or(epoch(TIMESTAMP '2024-01-31 00:00:00' - landed_at) <= 30 * 3600), false) AS is_recent,
           max(file_name) AS file_name, max(CAST(landed_at AS DATE)) AS landed_on
    FROM newest"""


@query("freshness", FRESH_SQL)
def freshness(spark, sf_dir):
    """Purchases are loaded files, other events are moves; dear ones have a malformed name."""
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    digits = F.when(F.col("value") < 100, stamp).otherwise(F.substring(stamp, 1, 8))
    ledger = table(spark, sf_dir, "events").select(
        F.lit("unl").alias("provider"),
        F.concat(F.lit("UNLFYM_Policy_"), digits, F.lit(".csv")).alias("file_name"),
        F.when(F.col("event_type") == "purchase", "loaded_to_postgres").otherwise(audit.MOVED).alias("status"),
        F.col("ts").cast("timestamp").alias("landed_at"),
    )
    now = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
    return audit.freshness(ledger, "unl", now).select(
        "found", "is_recent", "file_name", F.to_date("landed_at").alias("landed_on")
    )


def monthly_reports(spark, sf_dir):
    """Each month of orders is a report; months of odd years are another commission type."""
    orders = table(spark, sf_dir, "orders").withColumn("report_id", F.date_format("o_orderdate", "yyyyMM").cast("long"))
    months = orders.select("report_id", F.trunc("o_orderdate", "month").alias("month")).distinct()
    options = months.select(
        "report_id", F.date_format("month", "MM/dd/yyyy").alias("option_value"),
        F.when(F.year("month") % 2 == 0, "WA").otherwise("MA").alias("commission_type"),
    )
    reports = months.select(
        F.col("report_id").alias("id"), F.concat(F.lit("report_"), "report_id", F.lit(".csv")).alias("original_filename")
    )
    rows = orders.select(
        F.col("report_id").alias("source_report_id"), F.col("o_orderkey").alias("row_number"),
        F.col("o_custkey").cast("string").alias("policy_number"),
        F.concat(F.lit(" "), "o_orderpriority").alias("insured_name"), F.col("o_orderstatus").alias("agent_number"),
        *[F.lit(None).cast("string").alias(c) for c in (
            "first_name", "last_name", "agency", "transaction_type", "plan", "premium_paid_amount",
            "commission_rate", "commission_premium_amount", "advance_percent", "amount", "effective_date",
            "paid_to_date", "last_activity_date",
        )],
    )
    return options, reports, rows


@query("export_manifest", """
    SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS source_report_id,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS statement_date,
           concat('report_', strftime(o_orderdate, '%Y%m'), '.csv') AS original_filename,
           concat('WA_202JVV00_', strftime(o_orderdate, '%Y_%m_01'), '.csv') AS output_filename,
           count(*) AS row_count
    FROM orders
    WHERE year(o_orderdate) % 2 = 0 AND o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '2000-07-01'
    GROUP BY ALL""")
def export_manifest(spark, sf_dir):
    return export.report_manifest(
        *monthly_reports(spark, sf_dir), start=dt.date(1996, 3, 1), end=dt.date(2000, 6, 1)
    )


@query("export_reports", """
    SELECT concat('WA_202JVV00_', strftime(o_orderdate, '%Y_%m_01'), '.csv') AS output_filename, strftime(o_orderdate, '%Y%m') AS source_report_id,
           CAST(o_custkey AS VARCHAR) AS policy_nbr, o_orderpriority AS "desc", o_orderstatus AS agent_nbr, '007' AS first_name,
           'say "hi", Bob' AS last_name, NULL AS agency, NULL AS trans_type, NULL AS plan, concat(' ', o_orderstatus, ' ') AS prem_paid_amt,
           concat('a', chr(10), 'b') AS comm_rate, NULL AS comm_prem_amt, 'back\\slash' AS adv_per, CAST(o_orderkey AS VARCHAR) AS amount,
           NULL AS effective_date, NULL AS paid_to_date, ',' AS last_activity_date
    FROM orders WHERE year(o_orderdate) % 2 = 0""".replace("NULL AS", "CAST(NULL AS VARCHAR) AS"))
def export_reports(spark, sf_dir):
    """Written as CSV per report, compared with the manifest by number and content, then read back in full width."""
    options, reports, rows = monthly_reports(spark, sf_dir)
    rows = rows.withColumns({
        "first_name": F.lit("007"), "last_name": F.lit('say "hi", Bob'), "premium_paid_amount": F.concat(F.lit(" "), "agent_number", F.lit(" ")),
        "commission_rate": F.lit("a\nb"), "advance_percent": F.lit("back\\slash"), "amount": F.col("row_number").cast("string"),
        "last_activity_date": F.lit(","),
    })
    path = scratch_path(spark, "export")
    export.export_reports(export.report_manifest(options, reports, rows), rows, path)
    return export.read_export(spark, path)
