"""JSON array snapshots and the roster tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.sources import ranges
from feedloom.sources.files import NoFilesError, _file_system, landed
from feedloom.sources.names import snake_case


class PayloadError(ValueError):
    """The payload is not a JSON array of objects."""


def _first_character(spark: SparkSession, path: str) -> str:
    """First non-blank character of a file."""
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        while (code := stream.read()) != -1:
            if not chr(code).isspace() and code not in (0xEF, 0xBB, 0xBF):
                return chr(code)
    finally:
        stream.close()
    return ""


def read_json_array(
    spark: SparkSession, path: str, fields: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Objects of the JSON array files matching ``path``.

    With ``fields`` every value is text under its stored name, absent ones are NULL and others are dropped; files larger than a byte
    range are then read by several tasks each. ``limit`` keeps the first objects.
    """
    root, _, name = path.rpartition("/")
    files = landed(spark, root, name)
    if not files:
        raise NoFilesError(f"no payload at {path}")
    for file in files:
        if _first_character(spark, file.path) != "[":
            raise PayloadError(f"{file.path} must hold a JSON array of objects")
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if fields is None:
        rows = reader.json(path)
    else:
        schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
        large = [f.path for f in files if f.size > ranges.range_bytes(spark)] if limit is None else []
        small = [f.path for f in files if f.path not in set(large)]
        parts = [reader.schema(schema).json(small)] if small else []
        if large:
            parts.append(ranges.read_elements(spark, large, schema))
        rows = reduce(DataFrame.unionByName, parts).select(*[F.col(f).alias(snake_case(f)) for f in fields])
    return rows if limit is None else rows.limit(limit)


def snapshot_identity(snapshot: DataFrame, fields: Sequence[str], load_id: str) -> DataFrame:
    """Load and row ids for a snapshot, whose equal rows are one version anyway."""
    row_id = F.sha2(F.to_json(F.array(F.lit(load_id), *[F.col(f) for f in fields])), 256)
    return snapshot.select(*fields, F.lit(load_id).alias("load_id"), row_id.alias("row_id"))


# ---------------------------------------------------------------------- roster

@dataclass(frozen=True)
class RosterTable:
    name: str
    columns: tuple[tuple[str, str], ...]


# The six roster tables and their column types.
ROSTER = (
    RosterTable("roster_agent", (
        ("id", "string"), ("first_name", "string"), ("last_name", "string"),
        ("national_producer_number", "string"),
    )),
    RosterTable("roster_agency", (("id", "string"), ("name", "string"), ("is_person", "boolean"))),
    RosterTable("roster_carrier", (("id", "string"), ("name", "string"))),
    RosterTable("roster_agentcarrier", (
        ("id", "string"), ("agent_id", "string"), ("carrier_id", "string"), ("writing_number", "string"),
        ("status", "string"), ("start", "date"), ("end", "date"),
    )),
    RosterTable("roster_agencycarrier", (
        ("id", "string"), ("agency_id", "string"), ("carrier_id", "string"), ("writing_number", "string"),
        ("parent_id", "string"), ("status", "string"), ("start", "date"), ("end", "date"),
    )),
    RosterTable("roster_agentagency", (
        ("id", "string"), ("agent_id", "string"), ("agency_carrier_id", "string"), ("status", "string"),
        ("start", "date"), ("end", "date"), ("created", "timestamp"),
    )),
)


def project_roster(table: RosterTable, source: DataFrame) -> DataFrame:
    """The listed columns only; everything but booleans travels as text."""
    return source.select(*[
        (F.col(c) if kind == "boolean" else F.col(c).cast("string").cast(kind)).alias(c)
        for c, kind in table.columns
    ])


def roster_snapshot(source: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {t.name: project_roster(t, source[t.name]) for t in ROSTER}


def roster_from_jdbc(
    spark: SparkSession, url: str, schema: str, properties: Mapping[str, str], partitions: int = 1
) -> dict[str, DataFrame]:
    """The roster read from a relational database, columns pruned by the source.

    ``partitions`` above one splits each table by a hash of its id; keep it low, every
    partition is a connection.
    """
    def table(t: RosterTable) -> DataFrame:
        name = f"{schema}.{t.name}"
        if partitions == 1:
            return spark.read.jdbc(url, name, properties=dict(properties))
        slices = [f"mod(abs(hashtext(id::text)), {partitions}) = {i}" for i in range(partitions)]
        return spark.read.jdbc(url, name, predicates=slices, properties=dict(properties))

    return roster_snapshot({t.name: table(t) for t in ROSTER})


def roster_from_parquet(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return roster_snapshot({t.name: spark.read.parquet(f"{root}/{t.name}") for t in ROSTER})
