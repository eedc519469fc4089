"""Files written from the tables, then read through the library."""

import datetime as dt
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import functions as F

from feedloom.plans import flow
from feedloom.plans.feeds import manhattan
from feedloom.plans.specs import Route
from feedloom.queries import texts as x
from feedloom.queries.registry import query, table
from feedloom.queries.typing import MANHATTAN_TEXT
from feedloom.session import scratch_path
from feedloom.sinks.tables import Tables
from feedloom.sources import files as src
from feedloom.sources.names import stored_names
from feedloom.sources.snapshots import read_json_array
from feedloom.streaming.intake import start_intake

#: Headers as a carrier writes them.
HEADER = ("Policy Number", "polNo", "FYMRDR1PLA", "Wrtng Agt 1 No.", "Group No/Name")


def order_file(spark, sf_dir, header=HEADER):
    text = table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS a", "CAST(o_custkey AS STRING) AS b",
        "CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END AS c",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'two\nlines, \"quoted\"' ELSE o_orderpriority END AS d",
        "CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE 'x' END AS e",
    )
    return text.toDF(*HEADER).select(*[f"`{h}`" for h in header])


def write_csv(rows, path):
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


ORDER_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS policy_number, CAST(o_custkey AS VARCHAR) AS pol_no,
           {status} AS fymrdr1_pla,
           CASE WHEN o_orderkey % 5 = 0 THEN concat('two', chr(10), 'lines, "quoted"') ELSE o_orderpriority END AS wrtng_agt_1_nox,
           CASE WHEN o_orderkey % 5 = 1 THEN {blank} ELSE 'x' END AS group_no_name FROM orders"""
STORED = list(stored_names(HEADER).values())


@query("csv_route_scan", ORDER_SQL.format(status="nullif(o_orderstatus, 'P')", blank="NULL"))
def csv_route_scan(spark, sf_dir):
    """Renamed columns, quoted line breaks, and NULL tokens."""
    root = scratch_path(spark, "landing")
    write_csv(order_file(spark, sf_dir), f"{root}/orders")
    routes = [Route("orders", "orders/*.csv", "orders"), Route("absent", "absent/*.csv", "absent")]
    return src.read_routes(spark, root, routes, "1")["orders"].select(*STORED)


BROKEN_LINES = """
    SELECT CAST(o_orderkey AS VARCHAR) AS a, {b} AS b FROM orders"""


@query("csv_quoted_breaks", BROKEN_LINES.format(b="concat('x', chr(10), CAST(o_custkey AS VARCHAR), ',y \"', o_orderstatus, '\"')"))
def csv_quoted_breaks(spark, sf_dir):
    """Values whose line breaks leave fragments of the right width."""
    root = scratch_path(spark, "landing")
    rows = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS a", "concat('x\\n', o_custkey, ',y \"', o_orderstatus, '\"') AS b")
    write_csv(rows, f"{root}/orders")
    return src.read_routes(spark, root, [Route("orders", "orders/*.csv", "orders")], "1")["orders"].select("a", "b")


@contextmanager
def small_ranges(spark, size: int):
    """Every file counts as large, and a range has this many bytes."""
    settings = {"feedloom.rangeBytes": "0", "feedloom.cutBytes": str(size)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@query("csv_byte_ranges", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') || chr(10) || '"' || lang || '",.' AS body FROM documents""")
def csv_byte_ranges(spark, sf_dir):
    """Whole documents as quoted cells, with their line breaks and more, in files that are cut into small ranges."""
    root = scratch_path(spark, "landing")
    rows = table(spark, sf_dir, "documents").selectExpr("CAST(doc_id AS STRING) AS doc_id", "coalesce(text, '') || '\\n\"' || lang || '\",.' AS body")
    write_csv(rows, f"{root}/documents")
    route = Route("documents", "documents/*.csv", "documents", keep_tokens=True)
    with small_ranges(spark, 256 * 1024):
        rows = src.scan_route(spark, src.landed(spark, root, route.glob), route)
    return rows.select("doc_id", "body")


@query("csv_split_lines", BROKEN_LINES.format(b="concat('x,', CAST(o_custkey AS VARCHAR), ',y \"', o_orderstatus, '\"')"))
def csv_split_lines(spark, sf_dir):
    """Files that may be split by line, with quoted commas and quotes."""
    root = scratch_path(spark, "landing")
    rows = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS a", "concat('x,', o_custkey, ',y \"', o_orderstatus, '\"') AS b")
    write_csv(rows, f"{root}/orders")
    route = Route("orders", "orders/*.csv", "orders", multiline=False)
    return src.read_routes(spark, root, [route], "1")["orders"].select("a", "b")


@query("csv_contract", ORDER_SQL.format(status="CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END", blank="''"))
def csv_contract(spark, sf_dir):
    """An exact header, checked up front; tokens and blanks stay text."""
    root = scratch_path(spark, "landing")
    write_csv(order_file(spark, sf_dir), f"{root}/orders")
    route = Route("orders", "orders/*.csv", "orders", columns=HEADER, keep_tokens=True)
    src.check_contracts(spark, root, [route])
    return src.read_routes(spark, root, [route], "1")["orders"].select(*STORED)


@query("csv_new_columns", ORDER_SQL.format(status="nullif(o_orderstatus, 'P')", blank="NULL") + """
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), NULL, NULL, NULL FROM orders""")
def csv_new_columns(spark, sf_dir):
    """Older files lack three columns."""
    root = scratch_path(spark, "landing")
    write_csv(order_file(spark, sf_dir, HEADER[:2]), f"{root}/orders/old")
    write_csv(order_file(spark, sf_dir), f"{root}/orders/new")
    return src.read_routes(spark, root, [Route("orders", "orders/*/*.csv", "orders")], "1")["orders"].select(*STORED)


@query("jsonl_route_scan", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""")
def jsonl_route_scan(spark, sf_dir):
    root = scratch_path(spark, "landing")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").write.json(f"{root}/customers")
    route = Route("customers", "customers/*.json", "customers", parser="jsonl")
    return src.read_routes(spark, root, [route], "1")["customers"].select("c_custkey", "c_name", "c_mktsegment")


@query("parquet_route_scan", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def parquet_route_scan(spark, sf_dir):
    root = scratch_path(spark, "landing")
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    table(spark, sf_dir, "lineitem").select(*columns).write.parquet(f"{root}/lines")
    route = Route("lines", "lines/*.parquet", "lines", parser="parquet")
    return src.read_routes(spark, root, [route], "1")["lines"].select(*columns)


@query("row_identity", """
    SELECT source AS source_file, count(*) AS row_count, count(*) AS id_count, count(DISTINCT (text, lang)) AS text_count
    FROM documents GROUP BY source""")
def row_identity(spark, sf_dir):
    """Byte-identical documents of one source still get an id each."""
    rows = table(spark, sf_dir, "documents").select(
        "text", "lang", F.col("source").alias("source_file"),
        F.lit(dt.datetime(2026, 1, 1)).cast("timestamp").alias("source_modified_at"),
    )
    return src.identified(rows, "1", copies_per_task=2).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("row_id").alias("id_count"),
        F.countDistinct("text", "lang").alias("text_count"),
    )


PAYLOAD = ("polNo", "agtFirstName", "premium", "hnlStatus", "upline")


@query("json_snapshot", """
    SELECT CAST(c_custkey AS VARCHAR) AS pol_no, c_name AS agt_first_name, CAST(c_nationkey AS VARCHAR) AS premium,
           CASE WHEN c_nationkey > 4 THEN c_mktsegment END AS hnl_status, CAST(NULL AS VARCHAR) AS upline FROM customer""")
def json_snapshot(spark, sf_dir):
    """Arrays of up to a thousand customers, one payload file each; unknown fields drop."""
    root = scratch_path(spark, "payload")
    record = F.struct(
        F.col("c_custkey").alias("polNo"), F.col("c_name").alias("agtFirstName"), F.col("c_nationkey").alias("premium"),
        F.when(F.col("c_nationkey") > 4, F.col("c_mktsegment")).alias("hnlStatus"), F.lit(1).alias("unknownField"),
    )
    payloads = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 1000)).agg(
        F.to_json(F.collect_list(record)).alias("value")
    )
    payloads.select("value").write.option("maxRecordsPerFile", 1).text(root)
    return read_json_array(spark, f"{root}/*.txt", PAYLOAD)


ARRAY_DOCUMENTS = 10_000


@query("json_byte_ranges", """
    SELECT CAST(doc_id AS VARCHAR) AS pol_no, coalesce(text, '') || ' }, {"' AS agt_first_name, CAST(NULL AS VARCHAR) AS premium FROM documents""")
def json_byte_ranges(spark, sf_dir):
    """Arrays of documents with nested objects, and braces and quotes in texts, cut into small ranges."""
    root = scratch_path(spark, "payload")
    record = F.struct(
        F.col("doc_id").alias("polNo"), F.concat(F.coalesce("text", F.lit("")), F.lit(' }, {"')).alias("agtFirstName"),
        F.struct(F.col("lang").alias("a"), F.array(F.struct(F.lit("}").alias("b"))).alias("c")).alias("other"),
    )
    documents = table(spark, sf_dir, "documents")
    # Arrays are one value each while they are made, so their number grows with the documents and not their size.
    arrays = max(20, -(-documents.count() // ARRAY_DOCUMENTS))
    payloads = documents.groupBy(F.pmod("doc_id", F.lit(arrays))).agg(F.to_json(F.collect_list(record)).alias("value"))
    payloads.select("value").write.option("maxRecordsPerFile", 1).text(root)
    with small_ranges(spark, 64 * 1024):
        return read_json_array(spark, f"{root}/*.txt", PAYLOAD[:3])


@query("json_limit", """
    SELECT CAST(c_custkey AS VARCHAR) AS pol_no, c_name AS agt_first_name FROM customer ORDER BY c_custkey LIMIT 40""")
def json_limit(spark, sf_dir):
    """The first objects of an array, in its order."""
    root = scratch_path(spark, "payload")
    record = F.struct(F.col("c_custkey").alias("polNo"), F.col("c_name").alias("agtFirstName"))
    listed = table(spark, sf_dir, "customer").filter("c_custkey <= 1000").agg(F.to_json(F.array_sort(F.collect_list(record))).alias("value"))
    listed.write.text(root)
    return read_json_array(spark, f"{root}/*.txt", PAYLOAD[:2], limit=40)


@query("header_csv", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CASE WHEN c_nationkey > 4 THEN c_mktsegment ELSE '' END AS segment FROM customer""")
def header_csv(spark, sf_dir):
    """A plain CSV under its own header, replaced on each load; empty cells stay ''."""
    root = scratch_path(spark, "landing")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_nationkey") > 4, F.col("c_mktsegment")).alias("segment")
    )
    write_csv(rows, f"{root}/customers")
    tables = Tables(spark, f"{root}/tables")
    tables.replace("raw/customers", rows.limit(0).select(*[F.col(c).cast("string") for c in rows.columns]))
    return tables.replace("raw/customers", src.read_header_csv(spark, f"{root}/customers"))


# ------------------------------------------------------------------------ flows

DATED_TEXT = {**MANHATTAN_TEXT, "o_orderdate": "o_orderdate", "o_orderkey": "o_orderkey"}


def flow_sql(condition: str = "true") -> str:
    return f"""
    SELECT {x.sql_blank('policy')} AS policy, {x.sql_blank('status')} AS status,
           {x.sql_number(x.sql_blank('modal_premium'), '+-')} AS modal_premium FROM {x.derived_sql(DATED_TEXT)} WHERE {condition}"""


FLOW_SQL = flow_sql()
FLOW_COLUMNS = [c.raw for c in manhattan.COLUMNS if not c.raw.startswith(("wrtng_agt_2", "wrtng_agt_3", "wrtng_agt_4"))]
CLOCK = dt.datetime(2026, 7, 1, tzinfo=dt.timezone.utc)


def policy_cells(spark, sf_dir, condition):
    rows = x.derived(spark, sf_dir, DATED_TEXT).filter(condition)
    return rows.select(*[(F.col(c) if c in MANHATTAN_TEXT else F.lit(None).cast("string")).alias(c) for c in FLOW_COLUMNS])


def land(spark, sf_dir, root, condition):
    """Policy files of some orders, dropped where the feed looks for them."""
    rows, made = policy_cells(spark, sf_dir, condition), scratch_path(spark, "drop")
    # A plain write leaves a file with a header only where the first task has no rows; a partitioned one opens a file with its first row.
    rows.withColumn("part", F.lit(0)).write.partitionBy("part").option("header", True).csv(made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, folder = path(made).getFileSystem(spark._jsc.hadoopConfiguration()), f"{root}/manhattan/inbound"
    fs.mkdirs(path(folder))
    for made_file in fs.globStatus(path(f"{made}/part=*/part-*.csv")):
        fs.rename(made_file.getPath(), path(f"{folder}/{made_file.getPath().getName()}"))


def typed_policies(tables):
    rows = tables.read(flow.typed_name(manhattan.FEED.table))
    return rows.select("policy", "status", F.col("modal_premium").cast("double").alias("modal_premium"))


@query("load_flow", FLOW_SQL)
def load_flow(spark, sf_dir):
    """Two batch loads of a feed and a repeat that finds nothing new."""
    root = scratch_path(spark, "flow")
    tables = Tables(spark, f"{root}/tables")
    for load_id, condition in (("1", "o_orderdate < '1998-01-01'"), ("2", "o_orderdate >= '1998-01-01'")):
        land(spark, sf_dir, root, condition)
        flow.load(tables, manhattan.FEED, root, load_id, CLOCK)
    flow.load(tables, manhattan.FEED, root, "3", CLOCK)
    return typed_policies(tables)


NEWEST_LOAD = "year(o_orderdate) BETWEEN 1997 AND 1998 AND o_orderkey % 2 = 1"


@query("latest_by_statistics", flow_sql(NEWEST_LOAD))
def latest_by_statistics(spark, sf_dir):
    """Three loads of two files each, all of one time: the load id decides, then the name. Only that load's folder is read."""
    root = scratch_path(spark, "flow")
    tables = Tables(spark, f"{root}/tables")
    loads = (("10", "o_orderdate < '1997-01-01'"), ("9", "year(o_orderdate) BETWEEN 1997 AND 1998"), ("2", "o_orderdate >= '1999-01-01'"))
    for load_id, condition in loads:
        for part in (0, 1):
            land_named(spark, sf_dir, root, f"{condition} AND o_orderkey % 2 = {part}", f"load-{load_id}-{part}.csv")
        out = flow.load(tables, manhattan.FEED, root, load_id, CLOCK)
    rows = out["latest_typed"]
    return rows.select("policy", "status", F.col("modal_premium").cast("double").alias("modal_premium"))


def land_named(spark, sf_dir, root, condition, name):
    """One policy file under its name, as of a fixed time."""
    made = scratch_path(spark, "drop")
    policy_cells(spark, sf_dir, condition).coalesce(1).write.option("header", True).csv(made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, folder = path(made).getFileSystem(spark._jsc.hadoopConfiguration()), f"{root}/manhattan/inbound"
    fs.mkdirs(path(folder))
    fs.rename(fs.globStatus(path(f"{made}/part-*.csv"))[0].getPath(), path(f"{folder}/{name}"))
    fs.setTimes(path(f"{folder}/{name}"), 1_780_000_000_000, -1)


@query("stream_flow", FLOW_SQL)
def stream_flow(spark, sf_dir):
    """The same files through the stream, which is stopped and started again."""
    root = scratch_path(spark, "flow")
    tables = Tables(spark, f"{root}/tables")
    route = replace(manhattan.ROUTES[0], columns=tuple(FLOW_COLUMNS))
    for condition in ("o_orderdate < '1998-01-01'", "o_orderdate >= '1998-01-01'"):
        land(spark, sf_dir, root, condition)
        start_intake(tables, manhattan.FEED, route, root, f"{root}/checkpoint", lambda: CLOCK).awaitTermination()
    return typed_policies(tables)


@query("rebuild_counts", """
    SELECT name, CAST(CASE WHEN name = 'episodes' THEN 0 WHEN name LIKE 'latest%' THEN late ELSE n END AS BIGINT) AS n
    FROM (SELECT unnest(['typed', 'history', 'episodes', 'latest_raw', 'latest_typed']) AS name),
         (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderdate >= '1998-01-01') AS late FROM orders)""")
def rebuild_counts(spark, sf_dir):
    """A feed loaded from two files and rebuilt from three, and the rows of each refreshed table."""
    root = scratch_path(spark, "flow")
    tables = Tables(spark, f"{root}/tables")
    feed = replace(manhattan.FEED, routes=(replace(manhattan.ROUTES[0], columns=tuple(FLOW_COLUMNS)),))
    for part in (0, 1):
        land_named(spark, sf_dir, root, f"o_orderdate < '1998-01-01' AND o_orderkey % 2 = {part}", f"part-{part}.csv")
    flow.load(tables, feed, root, "1", CLOCK, refresh_derived=False)
    land_named(spark, sf_dir, root, "o_orderdate >= '1998-01-01'", "part-2.csv")
    counts = flow.row_counts(flow.rebuild(tables, feed, root, "2", CLOCK))
    return spark.createDataFrame(list(counts.items()), "name string, n long")
