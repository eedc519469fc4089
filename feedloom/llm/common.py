"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words as every operator here reads them (ASCII white space only).
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Only the key and the text, null texts empty. Other columns cannot clash with an operator's own."""
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, so that added columns cannot clash with its names."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of a string column; nulls are empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def rows_of(out: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)


def in_parts(batches: Batches, column: str, size: int = 4_000_000) -> Batches:
    """The batches in parts of about ``size`` bytes of ``column``, so that what a task copies of them stays small."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(batch):
            done = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, end - at)
            at = end


def add_columns(schema: pa.Schema, work: Callable[[pa.RecordBatch], dict[str, list]]) -> Callable[[Batches], Batches]:
    """A function for mapInArrow that turns each batch into rows of ``schema``, one batch at a time."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield rows_of(work(batch), schema)

    return run
