"""Report export: one folder of CSV per report, with a manifest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.session import cut

# Exported columns and the report columns they come from.
EXPORT_COLUMNS = {
    "policy_nbr": "policy_number",
    "desc": "insured_name",
    "agent_nbr": "agent_number",
    "first_name": "first_name",
    "last_name": "last_name",
    "agency": "agency",
    "trans_type": "transaction_type",
    "plan": "plan",
    "prem_paid_amt": "premium_paid_amount",
    "comm_rate": "commission_rate",
    "comm_prem_amt": "commission_premium_amount",
    "adv_per": "advance_percent",
    "amount": "amount",
    "effective_date": "effective_date",
    "paid_to_date": "paid_to_date",
    "last_activity_date": "last_activity_date",
}
TRIMMED = ("policy_nbr", "desc", "agent_nbr", "first_name", "last_name", "agency", "trans_type", "plan")
WEEKLY_ADVANCE = "WA"
FOLDER = ("output_filename", "source_report_id")
#: Quotes are doubled and blanks kept, so any CSV reader gets the exported values back; an empty text differs from NULL.
CSV = {
    "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "", "emptyValue": '""',
}


class ExportError(RuntimeError):
    """Written rows differ from the manifest."""


def report_manifest(
    options: DataFrame, reports: DataFrame, rows: DataFrame,
    start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """One row per weekly report: date, file names and row count; bounds inclusive.

    ``options`` (report_id, option_value, commission_type), ``reports`` (id,
    original_filename), ``rows`` (source_report_id, ...). Rows are counted per report
    first, so the joins only see one row per report.
    """
    counts = rows.groupBy("source_report_id").agg(F.count(F.lit(1)).alias("row_count"))
    weekly = options.filter(F.col("commission_type") == WEEKLY_ADVANCE).select(
        F.col("report_id").alias("source_report_id"), fn.date_slash(F.col("option_value")).alias("statement_date")
    )
    names = reports.select(F.col("id").alias("source_report_id"), "original_filename")
    manifest = weekly.join(names, "source_report_id").join(counts, "source_report_id")
    if start is not None:
        manifest = manifest.filter(F.col("statement_date") >= F.lit(start))
    if end is not None:
        manifest = manifest.filter(F.col("statement_date") <= F.lit(end))
    output = F.concat(F.lit("WA_202JVV00_"), F.date_format("statement_date", "yyyy_MM_dd"), F.lit(".csv"))
    return manifest.select(
        "source_report_id", "statement_date", "original_filename", output.alias("output_filename"), "row_count"
    ).orderBy("statement_date", "source_report_id")


def export_rows(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the listed reports with the exported columns and their folder."""
    columns = [
        (F.trim(source) if name in TRIMMED else F.col(source)).alias(name)
        for name, source in EXPORT_COLUMNS.items()
    ]
    return rows.select("source_report_id", "row_number", *columns).join(
        manifest.select(*FOLDER), "source_report_id"
    )


def export_reports(manifest: DataFrame, rows: DataFrame, path: str) -> DataFrame:
    """Write ``path/output_filename=…/source_report_id=…/part-*.csv`` and ``path/_manifest``.

    Rows are range partitioned on report and row number: files are in order, small
    reports share tasks and a very large report is spread over several files.
    """
    manifest = cut(manifest)
    listed = export_rows(manifest, rows)
    ordered = listed.repartitionByRange(*FOLDER, "row_number").sortWithinPartitions(*FOLDER, "row_number")
    ordered.drop("row_number").write.partitionBy(*FOLDER).options(**CSV).csv(path)
    manifest.write.options(**CSV).csv(f"{path}/_manifest")
    check_export(manifest, listed, path)
    return manifest


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The written rows as text, with report id and file name as they were."""
    columns = [*EXPORT_COLUMNS, *FOLDER]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST")
        .option("basePath", path).csv(f"{path}/output_filename=*")
    )


def _content(rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows per report and a sum over row hashes, which no order and no partitioning changes."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.xxhash64(F.to_json(F.array(*cells))).cast("decimal(38,0)")
    return rows.groupBy(F.col("source_report_id").cast("string").alias("source_report_id")).agg(
        F.count(F.lit(1)).alias(name), F.sum(digest).alias(f"{name}_content"),
    )


def check_export(manifest: DataFrame, listed: DataFrame, path: str) -> None:
    """Read the written rows again and compare their number and content per report."""
    written = _content(read_export(manifest.sparkSession, path), list(EXPORT_COLUMNS), "written")
    meant = _content(listed, list(EXPORT_COLUMNS), "meant")
    counts = manifest.select(F.col("source_report_id").cast("string").alias("source_report_id"), "row_count")
    wrong = counts.join(meant, "source_report_id", "full").join(written, "source_report_id", "full").filter(
        ~F.col("row_count").eqNullSafe(F.col("written")) | ~F.col("meant_content").eqNullSafe(F.col("written_content"))
    )
    if not wrong.isEmpty():
        raise ExportError(f"written rows differ from the manifest: {wrong.first()}")
