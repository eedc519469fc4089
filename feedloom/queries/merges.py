"""Merge semantics on orders and line items."""

import datetime as dt

from pyspark.sql import functions as F

from feedloom.operators import audit, merge, versions
from feedloom.queries.registry import query, table


def stored_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < "1998-01-01").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.lit("stored").alias("origin")
    )


def incoming_lines(spark, sf_dir):
    """Several lines per order; the most expensive one is preferred."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("price"),
        F.lit("incoming").alias("origin"),
    )


MERGE_SQL = """
    WITH stored AS (
        SELECT o_orderkey, o_totalprice AS price, 'stored' AS origin FROM orders WHERE o_orderdate < DATE '1998-01-01'
    ),
    incoming AS (
        SELECT l_orderkey AS o_orderkey, max(l_extendedprice) AS price, 'incoming' AS origin
        FROM lineitem GROUP BY l_orderkey
    ) """


def dearest():
    return [F.col("price").desc_nulls_last()]


@query("insert_only_merge", MERGE_SQL + """
    SELECT * FROM stored UNION ALL
    SELECT * FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stored)""")
def insert_only_merge(spark, sf_dir):
    return merge.insert_only(
        stored_orders(spark, sf_dir), incoming_lines(spark, sf_dir), ["o_orderkey"], dearest()
    )


@query("upsert", MERGE_SQL + """
    SELECT * FROM incoming UNION ALL
    SELECT * FROM stored WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)""")
def upsert(spark, sf_dir):
    return merge.upsert(stored_orders(spark, sf_dir), incoming_lines(spark, sf_dir), ["o_orderkey"], dearest())


@query("mirror_sync", MERGE_SQL + """
    SELECT i.o_orderkey, i.price, s.origin FROM incoming i LEFT JOIN stored s USING (o_orderkey)""")
def mirror_sync(spark, sf_dir):
    """The refreshed set carries no origin, so stored orders keep theirs."""
    refreshed = incoming_lines(spark, sf_dir).drop("origin")
    return merge.mirror(stored_orders(spark, sf_dir), refreshed, ["o_orderkey"], dearest())


@query("delete_missing", MERGE_SQL + """
    SELECT * FROM stored WHERE o_orderkey IN (SELECT o_orderkey FROM incoming)""")
def delete_missing(spark, sf_dir):
    return merge.delete_missing(stored_orders(spark, sf_dir), incoming_lines(spark, sf_dir), ["o_orderkey"])


@query("keyed_delete", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def keyed_delete(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return merge.delete_keys(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), returned, ["o_orderkey"]
    )


@query("correct_changed", """
    WITH computed AS (SELECT l_orderkey AS k, max(l_linestatus) AS status FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CASE WHEN k IS NULL THEN o_orderstatus ELSE status END AS o_orderstatus,
           k IS NOT NULL AND status IS DISTINCT FROM o_orderstatus AS changed
    FROM orders LEFT JOIN computed ON k = o_orderkey""")
def correct_changed(spark, sf_dir):
    computed = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_linestatus").alias("o_orderstatus")
    )
    stored = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    corrected = merge.correct_changed(stored, computed, ["o_orderkey"], ["o_orderstatus"])
    return corrected.withColumnRenamed("_changed", "changed")


RUN_TIME = dt.datetime(2026, 7, 1, 12, 0, 0)


@query("coalesce_upsert", """
    WITH old AS (
        SELECT o_orderpriority AS provider, o_orderkey, o_custkey AS size, o_orderdate AS landed
        FROM orders WHERE o_orderdate < DATE '1998-01-01'
    ),
    event AS (
        SELECT o_orderpriority AS provider, o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey + 1 END AS size,
               CASE WHEN o_orderstatus = 'P' THEN 'checksum' END AS err
        FROM orders WHERE o_orderdate >= DATE '1996-01-01'
    )
    SELECT coalesce(e.provider, o.provider) AS provider,
           concat('/in/', coalesce(e.o_orderkey, o.o_orderkey), '.csv') AS source_path,
           concat(coalesce(e.o_orderkey, o.o_orderkey), '.csv') AS file_name,
           coalesce(e.size, o.size) AS file_size_bytes,
           CASE WHEN e.o_orderkey IS NULL THEN 'moved_to_landing' ELSE 'loaded_to_postgres' END AS status,
           e.err AS error_message,
           CASE WHEN e.o_orderkey IS NULL THEN CAST(o.landed AS DATE) ELSE DATE '2026-07-01' END AS landed_on
    FROM old o FULL JOIN event e ON e.o_orderkey = o.o_orderkey""")
def coalesce_upsert(spark, sf_dir):
    """Each order is a file. Orders from 1996 on get two events, the second one final."""
    path = F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    files = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("provider"), path.alias("source_path"), path.alias("target_path"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
    )
    ledger = files.filter("o_orderdate < '1998-01-01'").select(
        "provider", "source_path", "target_path",
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
        F.col("o_custkey").alias("file_size_bytes"), F.lit(audit.MOVED).alias("status"),
        F.lit(None).cast("string").alias("error_message"), F.col("o_orderdate").cast("timestamp").alias("landed_at"),
    )
    size = F.when(F.col("o_orderstatus") != "F", F.col("o_custkey") + 1)
    step = F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("event_no")
    events = files.filter("o_orderdate >= '1996-01-01'").select("*", step).select(
        "event_no", "provider", "source_path", "target_path",
        F.when(F.col("event_no") == 0, size).alias("file_size_bytes"),
        F.when(F.col("event_no") == 0, audit.COPIED).otherwise("loaded_to_postgres").alias("status"),
        F.when((F.col("event_no") == 1) & (F.col("o_orderstatus") == "P"), "checksum").alias("error_message"),
    )
    return audit.record_files(events, ledger, RUN_TIME).select(
        "provider", "source_path", "file_name", "file_size_bytes", "status", "error_message",
        F.to_date("landed_at").alias("landed_on"),
    )


@query("either_key_anti", """
    WITH known AS (SELECT l_orderkey AS a, l_suppkey AS b FROM lineitem WHERE l_shipdate < DATE '1996-06-01')
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderkey NOT IN (SELECT a FROM known) AND o_custkey NOT IN (SELECT b FROM known)""")
def either_key_anti(spark, sf_dir):
    known = table(spark, sf_dir, "lineitem").filter("l_shipdate < '1996-06-01'").select("l_orderkey", "l_suppkey")
    return merge.either_key_unseen(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        known, {"o_orderkey": "l_orderkey", "o_custkey": "l_suppkey"},
    )


@query("repair_gap", """
    WITH typed AS (
        SELECT l_orderkey AS row_id, min(l_suppkey) AS raw_row_id, 'typed' AS origin
        FROM lineitem WHERE l_shipdate < DATE '1998-01-01' GROUP BY 1
    )
    SELECT * FROM typed UNION ALL
    SELECT o_orderkey, o_custkey, 'source' FROM orders
    WHERE o_orderkey NOT IN (SELECT row_id FROM typed) AND o_custkey NOT IN (SELECT raw_row_id FROM typed)""")
def repair_gap(spark, sf_dir):
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("raw_row_id"), F.lit("source").alias("origin")
    )
    typed = table(spark, sf_dir, "lineitem").filter("l_shipdate < '1998-01-01'").groupBy(
        F.col("l_orderkey").alias("row_id")
    ).agg(F.min("l_suppkey").alias("raw_row_id")).withColumn("origin", F.lit("typed"))
    return audit.repair_gap(source, typed)


@query("version_snapshot", """
    WITH hashed AS (
        SELECT doc_id, lang, CAST(md5(CAST(to_json([text, lang, source]) AS VARCHAR)) AS VARCHAR) AS row_hash
        FROM documents
    ),
    canonical AS (SELECT row_hash, min(doc_id) AS doc_id FROM hashed WHERE lang = 'en' GROUP BY 1),
    added AS (
        SELECT row_hash, min(doc_id) AS doc_id FROM hashed
        WHERE row_hash NOT IN (SELECT row_hash FROM canonical) GROUP BY 1
    )
    SELECT row_hash, doc_id, DATE '2026-06-30' AS first_seen FROM canonical UNION ALL
    SELECT row_hash, doc_id, DATE '2026-07-01' FROM added""")
def version_snapshot(spark, sf_dir):
    """English documents were fetched a day before the rest."""
    fields = ["text", "lang", "source"]
    documents = table(spark, sf_dir, "documents").select("doc_id", *fields)
    first = versions.new_versions(
        documents.filter("lang = 'en'"), None, fields, "doc_id", RUN_TIME - dt.timedelta(days=1)
    )
    return versions.version_snapshot(documents, first, fields, "doc_id", RUN_TIME).select(
        "row_hash", "doc_id", F.to_date("first_seen_at").alias("first_seen")
    )
