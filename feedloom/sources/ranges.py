"""Records of one large file by many tasks, where a record may hold line breaks or further objects.

Spark cuts a text file into byte ranges and, within them, into pieces that end with a separator; where a record begins and ends
depends on what came before. What came before is summed per range (quotes seen, braces open), a prefix over the few ranges of a
file gives the state each one starts in, and a running sum within the range the state of each piece. Records of a single piece go
on as they are. Only pieces of longer records meet, by record.

* CSV: pieces are lines, a quoted cell may go on in the next one. Summing quotes is only right if each quote opens or closes a cell or is
  doubled. Every line is checked against that, and a file with a stray quote is left to the reader that takes it whole.
* JSON arrays: pieces end with a closing brace. A record is an object of the array, which may hold objects, and braces in texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.session import cut, scratch_path, setting

#: Files of more bytes are read by ranges; smaller ones are one task's work in any case.
RANGE_BYTES = 128 * 1024 * 1024
#: Bytes of text that a task reads at least, range after range, if there is more than a range for each core.
TASK_BYTES = 32 * 1024 * 1024

# A whole cell of a line, then one that goes on. Possessive, so that long lines need no stack.
_CLOSED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_CELLS = rf'(?:(?:{_CLOSED}|[^",][^,]*+|),)*+'
_OPEN = r'"[^"]*+(?:""[^"]*+)*+$'
#: Whether a line that starts between cells, or inside one, ends inside a quoted cell.
OPENS = rf"^{_CELLS}{_OPEN}"
STAYS = rf'^[^"]*+(?:""[^"]*+)*+(?:$|"[^,]*+,{_CELLS}{_OPEN})'


def range_bytes(spark: SparkSession) -> int:
    return setting(spark, "feedloom.rangeBytes", RANGE_BYTES)


@contextmanager
def cutting(spark: SparkSession) -> Iterator[None]:
    """Text scanned inside is cut into ranges of ``feedloom.cutBytes``, if set; else as Spark cuts any file. Only text: stored rows,
    which are read outside, never need small ranges."""
    name, size = "spark.sql.files.maxPartitionBytes", spark.conf.get("feedloom.cutBytes", None)
    before = spark.conf.get(name)
    if size is not None:
        spark.conf.set(name, size)
    try:
        yield
    finally:
        if size is not None:
            spark.conf.set(name, before)


def pieces(spark: SparkSession, paths: Sequence[str], separator: str) -> DataFrame:
    """(path, range, nth, value, _metadata): the text between separators, numbered in the order of its range.

    A task reads many small ranges one after the other, so neither tasks nor stored files number as many as ranges.
    """
    rows = spark.read.option("lineSep", separator).text(list(paths))
    rows = rows.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("nth"), "value", "_metadata",
    )
    return rows.coalesce(max(spark.sparkContext.defaultParallelism, -(-size_of(spark, paths) // TASK_BYTES)))


def size_of(spark: SparkSession, paths: Sequence[str]) -> int:
    hadoop_paths = map(spark._jvm.org.apache.hadoop.fs.Path, paths)
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in hadoop_paths)


def count_of(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def before_range(sums: DataFrame, *columns: str) -> DataFrame:
    """For (path, range) sums: those of all earlier ranges of the file. One row per range, stored, so that its size is known."""
    earlier = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    told = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in columns]
    return cut(sums.select("path", "range", *told))


def running(rows: DataFrame, value: Column, carried: Column) -> Column:
    """The sum of ``value`` over all earlier pieces of the file, ``carried`` being that of its earlier ranges."""
    earlier = Window.partitionBy("path", "range").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    return carried + F.coalesce(F.sum(value).over(earlier), F.lit(0))


def assembled(rows: DataFrame, separator: str) -> DataFrame:
    """(record, _metadata) from pieces with ``opens`` and ``closes``: whether a record begins and ends with them."""
    alone = rows.filter(F.col("opens") & F.col("closes")).select(F.col("value").alias("record"), "_metadata")
    parts = rows.filter(~(F.col("opens") & F.col("closes")))
    so_far = Window.partitionBy("path", "range").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    parts = cut(parts.withColumn("record", F.sum(F.col("opens").cast("long")).over(so_far)))
    # What a range starts with belongs to the last record that an earlier range began.
    last = parts.groupBy("path", "range").agg(F.max("record").alias("began"))
    earlier = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    began = F.when(F.col("began") > 0, F.struct("range", F.col("began").alias("record")))
    owners = cut(last.select("path", "range", F.last(began, ignorenulls=True).over(earlier).alias("owner")))
    own = F.struct("range", "record")
    parts = parts.join(owners, ["path", "range"]).withColumn("owner", F.when(F.col("record") > 0, own).otherwise(F.col("owner")))
    placed = F.sort_array(F.collect_list(F.struct("range", "nth", "value")))
    whole = parts.groupBy("path", "owner").agg(placed.alias("all"), F.first("_metadata").alias("_metadata"))
    joined = F.array_join(F.transform("all", lambda p: p["value"]), separator)
    return alone.unionByName(whole.select(joined.alias("record"), "_metadata"))


# ------------------------------------------------------------------------- CSV

@dataclass
class Survey:
    """CSV files by how they are read: split by line, as records of several lines, or only whole."""

    lines: list[str]
    records: list[str]
    whole: list[str]
    #: The lines of the files with records.
    stored: DataFrame | None = None


def survey(spark: SparkSession, paths: Sequence[str]) -> Survey:
    """One scan tells files without an open line. The lines of the others are stored, since ranges may differ from scan to scan,
    and checked one by one."""
    quotes = count_of(F.col("value"), '"')
    line = F.rtrim(F.col("value"), F.lit("\r"))
    with cutting(spark):
        files = pieces(spark, paths, "\n").groupBy("path").agg(
            F.sum(quotes).alias("quotes"), F.max(quotes % 2).alias("odd"), F.max((quotes > 0) & line.rlike(OPENS)).alias("stray"),
            F.max(F.col("value").rlike(r"\r[\s\S]")).alias("returns"),
        ).collect()
    # With an odd sum a quote is stray, or the file ends inside a cell, which the other reader reports.
    whole = {r["path"] for r in files if r["returns"] or r["quotes"] % 2 or r["stray"] and not r["odd"]}
    broken = [r["path"] for r in files if r["odd"] and r["path"] not in whole]
    found = Survey([r["path"] for r in files if r["path"] not in whole and r["path"] not in broken], broken, sorted(whole))
    if broken:
        with cutting(spark):
            lines = cut(pieces(spark, broken, "\n"))
        checked = cut(_lines(lines))
        wrong = {r["path"] for r in checked.filter("wrong").select("path").distinct().collect()}
        found.whole += sorted(wrong)
        found.records = [p for p in broken if p not in wrong]
        found.stored = checked.filter(~F.col("path").isin(sorted(wrong))) if wrong else checked
    return found


def _lines(rows: DataFrame) -> DataFrame:
    """Stored lines with the state they start and end in, and whether the check by cells says otherwise."""
    quotes = count_of(F.col("value"), '"')
    sums = rows.groupBy("path", "range").agg(F.sum(quotes).alias("quotes"))
    rows = rows.join(before_range(sums, "quotes"), ["path", "range"])
    rows = rows.withColumn("inside", running(rows, quotes, F.col("before_quotes")) % 2 == 1)
    rows = rows.withColumn("goes_on", F.col("inside") != (quotes % 2 == 1))
    line = F.rtrim(F.col("value"), F.lit("\r"))
    told = F.when(F.col("inside"), line.rlike(STAYS)).otherwise(line.rlike(OPENS))
    return rows.withColumn("wrong", (quotes > 0) & (told != F.col("goes_on")))


def csv_records(lines: DataFrame) -> DataFrame:
    """(record, _metadata) from the stored lines of a survey, without headers and empty lines.

    As in the reader that takes files whole, line breaks within cells that are the file's own line end are line feeds.
    """
    # The header is the first piece of a file; it has no line breaks.
    header = lines.filter("range = 0").groupBy("path").agg(F.min("nth").alias("nth"), F.min_by(F.col("value").endswith("\r"), "nth").alias("returns"))
    header = cut(header)
    rows = lines.join(header.select("path", F.col("nth").alias("first"), "returns"), "path")
    rows = rows.filter((F.col("range") > 0) | (F.col("nth") > F.col("first")))
    value = F.when(F.col("goes_on"), F.col("value")).otherwise(F.rtrim("value", F.lit("\r")))
    rows = rows.withColumns({"opens": ~F.col("inside"), "closes": ~F.col("goes_on"), "value": value})
    # A carriage return before a break within a cell stands at the end of its line.
    broken = F.col("goes_on") & F.col("returns")
    rows = rows.withColumn("value", F.when(broken, F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")))
    return assembled(rows, "\n").filter(F.col("record") != "")


# ------------------------------------------------------------------------ JSON

#: Ends a stored object; raw, it cannot occur within one.
_OBJECT_END = "\x1e\n"


def read_elements(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The objects of JSON arrays. They are stored one by one, so that Spark's reader of JSON files reads them, text by text as in a whole file."""
    path = scratch_path(spark, "objects")
    json_elements(spark, paths).select("record").write.option("lineSep", _OBJECT_END).text(path)
    return spark.read.schema(schema).option("mode", "FAILFAST").option("lineSep", _OBJECT_END).json(path)


def json_elements(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(record, _metadata): the objects of JSON arrays as text."""
    with cutting(spark):
        rows = cut(pieces(spark, paths, "}"))
    plain = F.regexp_replace("value", r'\\.', "")
    quotes = count_of(plain, '"')
    sums = cut(rows.groupBy("path", "range").agg(F.sum(quotes).alias("quotes")))
    rows = rows.join(before_range(sums, "quotes"), ["path", "range"])
    rows = rows.withColumn("inside", running(rows, quotes, F.col("before_quotes")) % 2 == 1)
    # Texts go, from the first or the second quote on, so that only the braces of objects are left.
    outside = F.regexp_replace(F.when(F.col("inside"), F.concat(F.lit('"'), plain)).otherwise(plain), r'"[^"]*+(?:"|$)', "")
    closing = (F.col("inside") == (quotes % 2 == 1)).cast("long")
    rows = rows.withColumns({"ups": count_of(outside, "{"), "closing": closing})
    deep = cut(rows.groupBy("path", "range").agg(F.sum(F.col("ups") - F.col("closing")).alias("depth")))
    # The piece after the last brace counts as a closing one.
    torn = [r["path"] for r in deep.groupBy("path").agg(F.sum("depth").alias("depth")).filter("depth <> -1").select("path").collect()]
    if torn:
        raise ValueError(f"malformed, not a whole JSON array: {', '.join(sorted(torn))}")
    rows = rows.join(before_range(deep, "depth"), ["path", "range"])
    rows = rows.withColumn("depth", running(rows, F.col("ups") - F.col("closing"), F.col("before_depth")))
    # Between objects there is only the array itself; what follows the last object opens nothing.
    between = F.regexp_extract("value", r"^([^{]*+)", 1)
    top = (F.col("depth") == 0) & ~F.col("inside")
    wrong = F.raise_error(F.concat(F.lit("not a JSON array of objects: "), F.col("path"))).cast("boolean")
    rows = rows.filter(F.when(top & ~between.rlike(r"^\ufeff?\s*(?:\[|,|\]|\[\s*\])\s*$"), wrong).otherwise(F.lit(True)))
    rows = rows.withColumns({
        "opens": top & (F.col("ups") > 0), "closes": F.col("depth") + F.col("ups") - F.col("closing") == 0,
        "value": F.when(top, F.regexp_replace("value", r"^[^{]*+", "")).otherwise(F.col("value")),
    }).filter((F.col("depth") > 0) | F.col("opens"))
    return assembled(rows, "}").select(F.concat("record", F.lit("}")).alias("record"), "_metadata")
