"""Landed files as an available-now stream.

Each micro-batch runs the batch load steps, so a stream that is stopped, restarted or
fed one file at a time ends in the tables a single batch gives. The batch number names
the load; a repeated batch rewrites its own partition. There is no watermark: late
files are repaired per key by the history refresh, a watermark would drop them.

The file source remembers paths, so landed files must not be rewritten in place. Batch
loads also compare modification times and do pick up rewritten files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.plans import flow
from feedloom.plans.specs import FeedSpec, Route
from feedloom.session import cut, staging
from feedloom.sinks.tables import Tables
from feedloom.sources.files import ContractError, LandedFile, _cell, _lineage, csv_cells, decoded
from feedloom.sources.names import stored_names

FILES_PER_BATCH = 1000


def stream_csv(spark: SparkSession, root: str, route: Route, files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """A contracted CSV route as a stream of text cells under its header names, with file metadata.

    Header lines are rows of the stream, so that a file without any other row is seen as well. Quoted line breaks follow
    the route as in batch loads.
    """
    if route.columns is None:
        raise ValueError(f"route {route.name!r} needs columns to be streamed")
    folder, _, glob = f"{root.rstrip('/')}/{route.glob}".rpartition("/")
    reader = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger)
    rows = csv_cells(reader, route.columns, route.multiline, with_header=False)(folder)
    is_header = F.lit(True)
    for i, name in enumerate(route.columns):
        cell = F.ltrim(F.col(f"`{name}`"), F.lit("\ufeff")) if i == 0 else F.col(f"`{name}`")
        is_header = is_header & cell.eqNullSafe(F.lit(name))
    return rows.select(
        *[_cell(h, route.keep_tokens).alias(n) for h, n in stored_names(route.columns).items()], *_lineage(),
        decoded(F.col("_metadata.file_path")).alias("_path"), F.col("_metadata.file_size").alias("_size"), is_header.alias("_header"),
    )


def check_files(files: list, route: Route) -> None:
    """Every file of a micro-batch has the contracted header once."""
    for f in files:
        if f["_headers"] != 1:
            raise ContractError(f"{f['_path']} has the header of route {route.name!r} {f['_headers']} times")


def load_id_of(batch: int) -> str:
    """Sorts as text in batch order."""
    return f"{batch:012d}"


def start_intake(
    tables: Tables, feed: FeedSpec, route: Route, root: str, checkpoint: str,
    clock: Callable[[], dt.datetime],
    roster: Mapping[str, DataFrame] | None = None,
    files_per_trigger: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Run everything that has landed and stop; call again for later files."""

    def load_batch(rows: DataFrame, batch: int) -> None:
        load_id, now = load_id_of(batch), clock()
        with staging(tables.spark):
            rows = cut(rows)
            per_file = rows.groupBy("_path", "source_modified_at", "_size").agg(F.count_if("_header").alias("_headers"))
            files = per_file.collect()  # at most ``files_per_trigger``
            if not files:
                return
            check_files(files, route)
            landed = [
                LandedFile(f["_path"], f["source_modified_at"].astimezone(dt.timezone.utc), f["_size"]) for f in files
            ]
            flow.store(tables, feed, {route: (landed, rows.filter(~F.col("_header")).drop("_path", "_size", "_header"))}, load_id, now)
            flow.refresh(tables, feed, now, roster)

    stream = stream_csv(tables.spark, root, route, files_per_trigger)
    return (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


__all__ = ["FILES_PER_BATCH", "load_id_of", "start_intake", "stream_csv"]
