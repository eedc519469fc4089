"""Landed files: listing, headers, scans and row identity.

Listing and header checks are metadata work on the driver through the Hadoop file
system, so any storage Spark can read works. Rows are only ever read by tasks.
"""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans.specs import LINEAGE, Route
from feedloom.sources import ranges
from feedloom.sources.names import stored_names

# Cell texts read as NULL unless a route keeps them.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
#: Copies of one byte-identical line numbered by one task.
COPIES_PER_TASK = 1_000_000
NEVER_NULL = "\u0000"
#: Files that the driver lists or opens at once.
LISTING_THREADS = 16
#: Paths that one task looks up when Spark lists the files of a scan.
PATHS_PER_TASK = 100
#: What separates cells when a physical line is read as one cell; a line that has it fails the load.
LINE_CELL = "\u0001"


class ContractError(ValueError):
    """A header differs from the configured one."""


class NoFilesError(RuntimeError):
    """No landed file matches any route."""


@dataclass(frozen=True)
class LandedFile:
    path: str
    modified_at: dt.datetime
    size: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def landed(spark: SparkSession, root: str, glob: str, after: dt.datetime | None = None) -> list[LandedFile]:
    """Files matching ``glob``, optionally only those modified after an instant."""
    fs, pattern = _file_system(spark, f"{root.rstrip('/')}/{glob}")

    def listed(status) -> LandedFile | None:
        if not status.isFile():
            return None
        modified_at = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.timezone.utc)
        return LandedFile(status.getPath().toString(), modified_at, status.getLen())

    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        files = [f for f in pool.map(listed, fs.globStatus(pattern) or []) if f]
    return sorted((f for f in files if after is None or f.modified_at > after), key=lambda f: f.path)


def matching_routes(
    spark: SparkSession, root: str, routes: Iterable[Route], after: dt.datetime | None = None
) -> dict[Route, list[LandedFile]]:
    """Routes with files; routes without are dropped, none at all is an error."""
    found = {r: landed(spark, root, r.glob, after) for r in routes}
    found = {r: files for r, files in found.items() if files}
    if not found:
        raise NoFilesError(f"no file under {root} matches a route")
    return found


def headers_of(spark: SparkSession, files: Sequence[LandedFile]) -> dict[LandedFile, tuple[str, ...]]:
    """First line of each CSV file as column names. Classes are looked up once and not per file: each name is a call to the JVM."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to_path, buffered, decoding = jvm.org.apache.hadoop.fs.Path, jvm.java.io.BufferedReader, jvm.java.io.InputStreamReader
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header_of(file: LandedFile) -> tuple[str, ...]:
        path = to_path(file.path)
        stream, codec = path.getFileSystem(conf).open(path), codecs.getCodec(path)
        if codec is not None:
            stream = codec.createInputStream(stream)
        try:
            line = buffered(decoding(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        if not line:
            raise ContractError(f"{file.name} has no header")
        return tuple(next(csv.reader([line.lstrip("\ufeff")])))

    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        return dict(zip(files, pool.map(header_of, files)))


def check_header(actual: Sequence[str], route: Route, file_name: str) -> None:
    """Ordered, case-exact equality with the contract."""
    if route.columns is not None and tuple(actual) != route.columns:
        raise ContractError(
            f"columns of {file_name} do not match the contract "
            f"(expected {len(route.columns)}, got {len(actual)})"
        )


def check_required(actual: Sequence[str], route: Route, file_name: str) -> None:
    """Columns without which rows have no meaning; every other column may be missing."""
    missing = sorted(set(route.required) - set(stored_names(actual).values()))
    if missing:
        raise ContractError(f"{file_name} lacks {', '.join(missing)}")


def check_contracts(spark: SparkSession, root: str, routes: Iterable[Route]) -> int:
    """Check all contracted headers before anything is replaced; returns the count."""
    checked = 0
    for route in routes:
        if route.parser != "csv" or route.columns is None:
            continue
        files = landed(spark, root, route.glob)
        for file, header in headers_of(spark, files).items():
            check_header(header, route, file.name)
        checked += len(files)
    if not checked:
        raise NoFilesError(f"no contracted file under {root}")
    return checked


# ----------------------------------------------------------------------- scans

def decoded(uri: Column) -> Column:
    """File metadata is URI text, where a plus stands for itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def _lineage() -> list[Column]:
    return [
        decoded(F.col("_metadata.file_name")).alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_modified_at"),
    ]


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _cell(name: str, keep_tokens: bool) -> Column:
    cell = F.col(f"`{name}`")
    if keep_tokens:
        return F.coalesce(cell, F.lit(""))
    return F.when(~cell.isin(*NULL_TOKENS), cell)


def csv_cells(reader, header: Sequence[str], multiline: bool, with_header: bool) -> Callable[..., DataFrame]:
    """``load(paths)`` for a batch or stream reader: the file's cells as text under ``header``, and file metadata.

    Any malformed line fails the load and names the file. Files that are split by line are read line by line first: a line
    with an odd number of quotes has an open quote, so its record would go on in the next line.
    """
    reader = reader.format("csv").option("columnPruning", False).option("mode", "FAILFAST").option("header", with_header)
    if multiline:
        reader = (
            reader.schema(_text_schema(header)).option("enforceSchema", False).option("multiLine", True)
            .option("escape", '"').option("nullValue", NEVER_NULL).option("emptyValue", "")
        )
        return lambda *paths: reader.load(*paths).select("*", "_metadata")

    lines = reader.schema("line string").option("sep", LINE_CELL).option("quote", "").option("nullValue", NEVER_NULL)

    def load(*paths) -> DataFrame:
        rows = lines.load(*paths).select("line", "_metadata")
        quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
        file = decoded(F.col("_metadata.file_path"))
        open_quote = F.raise_error(F.concat(F.lit("a quoted line break, but the route splits files by line: "), file))
        checked = F.when(quotes % 2 == 1, open_quote.cast("string")).otherwise(F.col("line"))
        return parsed_cells(rows.select(checked.alias("record"), "_metadata"), header)

    return load


def parsed_cells(records: DataFrame, header: Sequence[str]) -> DataFrame:
    """The cells of ``record`` texts under ``header``; a malformed one fails the load and names its file."""
    cells = [f"c{i}" for i in range(len(header))]
    schema = ", ".join(f"{c} string" for c in [*cells, "bad"])
    options = {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "escape": '"', "nullValue": NEVER_NULL, "emptyValue": "",
    }
    rows = records.select(F.from_csv("record", schema, options).alias("cells"), "_metadata")
    file = decoded(F.col("_metadata.file_path"))
    malformed = F.raise_error(F.concat(F.lit("malformed line in "), file)).cast("boolean")
    rows = rows.filter(F.when(F.col("cells.bad").isNotNull(), malformed).otherwise(F.lit(True)))
    return rows.select(*[F.col(f"cells.{c}").alias(h) for c, h in zip(cells, header, strict=True)], "_metadata")


def _plain_path(path: str) -> str:
    """A path as the listing has it, whichever way the scheme's slashes are written."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", path)


@contextmanager
def listing(spark: SparkSession, paths: int) -> Iterator[None]:
    """Scans that are made inside look up many paths with one task; else Spark gives each path a task of its own."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), max(spark.sparkContext.defaultParallelism, -(-paths // PATHS_PER_TASK)))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scan_csv(spark: SparkSession, files: Sequence[LandedFile], header: Sequence[str], route: Route) -> DataFrame:
    """Files sharing one header, as text under stored names, with lineage.

    Of a route whose files may have quoted line breaks, files larger than a byte range are read by several tasks each.
    """
    found = ranges.Survey([], [], [])
    paths = [f.path for f in files]
    if not route.multiline:
        found.lines = paths
    else:
        large = [f.path for f in files if f.size > ranges.range_bytes(spark)]
        if large:
            listed = {_plain_path(p): p for p in large}
            found = ranges.survey(spark, large)
            found.lines, found.whole = ([listed[_plain_path(unquote(p))] for p in part] for part in (found.lines, found.whole))
        found.whole += [p for p in paths if p not in set(large)]
    with listing(spark, len(paths)):
        scans = [
            csv_cells(spark.read, header, multiline, with_header=True)(part)
            for part, multiline in ((found.lines, False), (found.whole, True)) if part
        ]
    if found.records:
        scans.append(parsed_cells(ranges.csv_records(found.stored), header))
    cells = [_cell(h, route.keep_tokens).alias(n) for h, n in stored_names(header).items()]
    return reduce(DataFrame.unionByName, [rows.select(*cells, *_lineage()) for rows in scans])


def scan_route(spark: SparkSession, files: Sequence[LandedFile], route: Route) -> DataFrame:
    """All files of a route as one frame. Files may add columns over time: each
    distinct header is one scan, absent columns are NULL."""
    if route.parser == "csv":
        by_header = defaultdict(list)
        for file, header in headers_of(spark, files).items():
            check_header(header, route, file.name)
            check_required(header, route, file.name)
            by_header[header].append(file)
        scans = [scan_csv(spark, part, header, route) for header, part in by_header.items()]
        rows = scans[0]
        for more in scans[1:]:
            rows = rows.unionByName(more, allowMissingColumns=True)
        return rows
    paths = [f.path for f in files]
    if route.parser == "jsonl":
        rows = spark.read.option("primitivesAsString", True).option("mode", "FAILFAST").json(paths)
    elif route.parser == "parquet":
        rows = spark.read.option("mergeSchema", True).parquet(*paths)
    else:
        raise ValueError(f"unknown parser {route.parser!r} on route {route.name!r}")
    names = stored_names(rows.columns)
    return rows.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *_lineage())


# -------------------------------------------------------------------- identity

def identified(rows: DataFrame, load_id: str, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Add ``load_id`` and ``row_id``.

    The id hashes the file, its modification time, all values and the copy number
    among byte-identical rows, so it is the same on any retry or partitioning. Copies
    are counted (map-side combined) and written out again by number: identical rows
    need no order, and a line repeated without end is spread over many tasks.
    """
    values = [c for c in rows.columns if c not in LINEAGE]
    lineage = ["source_file", "source_modified_at"]
    counted = rows.groupBy(*values, *lineage).agg(F.count(F.lit(1)).alias("_copies"))
    few = counted.filter(F.col("_copies") <= copies_per_task).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    )
    step = F.lit(copies_per_task).cast("long")
    many = (
        counted.filter(F.col("_copies") > copies_per_task)
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"), step)))
        .repartition("_from", *values, *lineage)
        .withColumn("_copy", F.explode(F.sequence(
            F.col("_from"), F.least(F.col("_from") + step - 1, F.col("_copies"))
        )))
        .drop("_from")
    )
    row_id = F.sha2(F.to_json(F.array(
        F.col("source_file"), F.unix_micros("source_modified_at").cast("string"),
        F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), F.col("_copy").cast("string"),
    )), 256)
    return few.unionByName(many).select(*values, *lineage, F.lit(load_id).alias("load_id"), row_id.alias("row_id"))


def read_routes(
    spark: SparkSession, root: str, routes: Iterable[Route], load_id: str, after: dt.datetime | None = None
) -> dict[str, DataFrame]:
    """{table: identified rows} for every route with files."""
    found = matching_routes(spark, root, routes, after)
    return {r.table: identified(scan_route(spark, files, r), load_id) for r, files in found.items()}


def read_header_csv(spark: SparkSession, path: str) -> DataFrame:
    """One plain CSV as text rows under its own header; empty cells stay ''."""
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])
