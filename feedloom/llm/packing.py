"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous sweeps.

Documents become token ids in tasks; each is cut into pieces of at most ``CAPACITY`` tokens. Lengths and gaps are
whole numbers up to ``CAPACITY``, so the range-sorted documents and the range-sorted gaps are both held as runs: a
length with its number of pieces, a gap with the runs of sequences that have it. A sweep takes the longest length that
is left and finds its successor, the smallest gap that holds it. All pieces of that length ask for that gap at
once; the conflict is resolved by rank, the first ranks get the run's sequences in order, and the rest sweep again. Gaps are
updated, and sequences are opened only when no gap is left. That is best-fit decreasing, one step per run
instead of one per document.

The plan covers at most ``CAPACITY`` lengths and its size does not depend on the number of documents, so it is made on
the driver and sent to the tasks. What grows with the data stays distributed: counting lengths, ranking the pieces of a
length (in salted ranges, so a length that a third of all documents share is not one task's work), and
looking up each rank's sequence and offset.

Defined results: a null or empty text is the end token alone. Rows repeated are packed as often as they occur. Pieces of equal
length are ranked by salt, doc_id (nulls first), piece and checksum; equal rows are interchangeable. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import os
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import Batches, as_bytes, in_parts
from feedloom.session import cut

CAPACITY = 4096
END = 1
#: Words whose ids a worker keeps: those met lately, and as many from before. It changes nothing but time.
CACHE = 100_000
#: Bytes of text whose words are looked up together.
STRIP = 4_000_000
#: Pieces of one length that are ranked together.
RANK_ROWS = 1000

#: Latin letters followed by ASCII marks, which are neither letters, digits nor white space.
_MARKED = "^(?P<head>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<tail>[!-/:-@[-`{-~]+)$"
#: The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = dict(zip(sorted(set(range(256)) - _PRINTABLE), range(256, 512), strict=False))
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of a text, word by word.

    The vocabulary's tokenizer drops white space and never joins across it, so a text's ids are its words' ids
    one after the other. It lower-cases, too, so words are looked up in lower case unless the text
    may hold a special token, which is matched before that. The words of a strip of texts are split and numbered in
    Arrow, each different one is encoded once, and all ids are gathered by number.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, list[int]] = {}
        self.old: dict[bytes, list[int]] = {}

    def _encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word.

        A word of Latin letters is one unit that normalising only lower-cases, so it goes to the vocabulary's model at once.
        """
        split = self.tokenizer.model.tokenize
        out: list[list[int]] = [[]] * len(words)
        rest = []
        for i, word in enumerate(words):
            if word.isalpha():
                out[i] = [token.id for token in split(word.lower().decode())]
            elif _latin(word):
                out[i] = [token.id for token in split(word.decode().lower().encode().decode("latin-1").translate(_BYTES))]
            elif word:
                rest.append(i)
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False), strict=True):
            out[i] = x.ids
        return out

    def _known(self, words: list[bytes], often: np.ndarray) -> list[list[int]]:
        """Ids of different words, those met lately from memory. Words that occur ``often`` are kept there."""
        young, old = self.young, self.old
        if len(young) > CACHE:
            self.young, self.old = young, old = {}, young
        out = [young.get(w) or old.get(w) for w in words]
        holes = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(holes, self._encode([words[i] for i in holes]), strict=True):
            out[i] = ids
        young.update((words[i], out[i]) for i in np.flatnonzero(often)[:CACHE].tolist())
        return out

    def _table(self, words: pa.Array, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words end to end, and their numbers. A run of marks after Latin letters is a unit of its own."""
        parts = pc.extract_regex(words, _MARKED)
        heads = pc.if_else(parts.is_valid(), parts.field("head"), words).dictionary_encode()
        tails = pc.if_else(parts.is_valid(), parts.field("tail"), pa.scalar("", words.type)).dictionary_encode()
        head, tail = heads.indices.to_numpy().astype(np.int64), tails.indices.to_numpy().astype(np.int64)
        found = []
        for column, code in ((heads, head), (tails, tail)):
            units = column.dictionary.view(pa.large_binary()).to_pylist()
            found += self._known(units, np.bincount(code, count, len(units)) > 1)
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
        tail += len(heads.dictionary)
        return gathered(flat, size, np.stack([head, tail], axis=1).ravel()), size[head] + size[tail]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without an end token."""
        folded = pa.array([t if b"<|" in t else t.lower() for t in texts], pa.large_binary()).view(pa.large_string())
        split = pc.ascii_split_whitespace(folded)
        coded = split.flatten().dictionary_encode()
        words = coded.indices.to_numpy()
        flat, size = self._table(coded.dictionary, np.bincount(words, minlength=len(coded.dictionary)))
        data = gathered(flat, size, words).astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(size[words])])[split.offsets.to_numpy()] * 4
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def gathered(flat: np.ndarray, size: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The stretches of ``flat``, of these sizes, laid end to end in this order."""
    start, mine = (np.cumsum(size) - size)[order], size[order]
    return flat[np.repeat(start - (np.cumsum(mine) - mine), mine) + np.arange(mine.sum())]


def _latin(word: bytes) -> bool:
    """Whether the word is all Latin letters."""
    if word.isalpha() or word.isascii():
        return word.isalpha()
    text = word.decode()
    return text.isalpha() and max(text) < "\u0100"


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves if asked for."""
    key = docs.schema["doc_id"]
    schema = T.StructType([
        key, T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), *([T.StructField("ids", T.BinaryType())] if ids else []),
    ])
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches: Batches) -> Batches:
        work = encoder(vocabulary)
        for batch in in_parts(batches, "text", STRIP):
            row, piece, start, length, crc, held = [], [], [], [], [], []
            for i, data in enumerate(work.ids(as_bytes(batch.column("text")))):
                data += end
                for nth, at in enumerate(range(0, len(data), capacity * 4)):
                    part = data[at:at + capacity * 4]
                    row.append(i)
                    piece.append(nth)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        held.append(part)
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()), *([pa.array(held, pa.binary())] if ids else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: from that rank on, one piece per sequence.

    ``counts`` has the number of pieces of each length.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []
    placed: list[tuple[int, int, int, int]] = []
    opened = 0

    def leave(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                many = math.ceil(left / (capacity // length))
                leave(capacity, opened, many)
                opened += many
                continue
            gap = gaps[at]
            first, many = runs[gap].pop()
            if not runs[gap]:
                del runs[gap], gaps[at]
            each = gap // length
            full = min(many, left // each)
            for nth in range(each if full else 0):
                placed.append((length, rank + nth * full, first, capacity - gap + nth * length))
            rank, left = rank + full * each, left - full * each
            leave(gap - each * length, first, full)
            first, many = first + full, many - full
            if many and left and left < each:
                for nth in range(left):
                    placed.append((length, rank + nth, first, capacity - gap + nth * length))
                leave(gap - left * length, first, 1)
                rank, left, first, many = rank + left, 0, first + 1, many - 1
            leave(gap, first, many)
    return np.array(sorted(placed), dtype=np.int64).reshape(-1, 4)


def ranked(parts: DataFrame) -> DataFrame:
    """``parts`` with ``rank``: its number, from 0, among the pieces of its length."""
    most = parts.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(1, math.ceil(most / RANK_ROWS))).cast("long"))
    parts = parts.withColumn("salt", salt)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("length", "salt").agg(F.count("*").alias("n"))
    starts = starts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    joined = parts.join(starts, ["length", "salt"])
    return joined.withColumn("rank", F.col("before") + F.row_number().over(inside) - 1).drop("before", "salt")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` with ``sequence_id`` and ``offset``; with ``ids``, each piece's ids as bytes."""
    parts = cut(pieces(docs, vocabulary, capacity, ids))
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    places = docs.sparkSession.sparkContext.broadcast(plan(counts, capacity))
    rows = ranked(parts)
    schema = T.StructType([*(f for f in rows.schema if f.name != "rank"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Batches) -> Batches:
        length, rank, first, offset = places.value.T
        steps = length << 44 | rank
        for batch in batches:
            mine = batch.column("rank").to_numpy()
            at = np.searchsorted(steps, batch.column("length").to_numpy() << 44 | mine, side="right") - 1
            rest = [batch.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(first[at] + mine - rank[at]), pa.array(offset[at])], names=schema.names)

    return rows.mapInArrow(run, schema)
