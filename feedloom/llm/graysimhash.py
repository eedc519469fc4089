"""SimHash near-duplicate classes over a Gray-ordered hierarchical index.

A document's fingerprint takes, bit by bit, the majority of the XXH64 values of its word shingles. Two
fingerprints link at ``bits`` or fewer differing bits, and a class is what links connect.

*Dealing.* Equal fingerprints are one vertex. The 64 bits are cut into ``bits + 2`` parts; a pair with at most ``bits``
differing bits agrees in two parts at least, so it meets under one of the keys made of two parts. A key
with more than ``GROUP`` fingerprints is not searched as it is: its fingerprints are keyed again on two of ``bits + 2`` parts
of the bits still free, as often as needed. At most eight bits are free in the end, so a group cannot have
more than 256 different fingerprints, whatever the data. Nothing is dropped on the way.

*Searching.* Within a group fingerprints are sorted by Gray rank, so neighbours share long bit patterns. Each node
of the index keeps the bits that all below it share; what an upper node holds is masked out below. A query adds up
differing bits from the root on and leaves a whole subtree as soon as the sum exceeds ``bits``.

*Classes.* A group emits a forest, not all its links: connectivity is the same. The forests are contracted over
the whole table, each vertex into its least neighbour in a drawn order, until no link is left. Every round is written to the
shared folder. No task and not the driver holds a class.

Defined results: null and empty texts have fingerprint zero and link like any other. A text with fewer words than a
shingle is one shingle. component_id is the smallest doc_id of the class, nulls aside. Rows repeated are alike. An
empty table gives an empty result. ``drop_near_copies`` keeps one row per class: the smallest doc_id (nulls last), then the
smallest text hash; other columns pass through it unchanged.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import Batches, as_bytes, in_parts, packed
from feedloom.session import cut

SHINGLE = 3
BITS = 2
SEED = 42
#: Fingerprints under one key that are searched together; more are keyed again on further bits.
GROUP = 256
#: Children of an index node.
FANOUT = 8
#: Shingles whose bits are counted at once, which bounds memory for very long texts.
STRIP = 1 << 15


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the words' shingles; zero without words."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(text, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    spans = zip((ends - size)[: 1 - shingle].tolist() if shingle > 1 else (ends - size).tolist(), ends[shingle - 1:].tolist(), strict=True)
    values = np.array([xxhash.xxh64_intdigest(text[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), STRIP):
        strip = values[at:at + STRIP].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(strip, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``fp``: the fingerprint as a signed long."""
    rest = [f for f in docs.schema if f.name != text]

    def run(batches: Batches) -> Batches:
        for batch in in_parts(batches, text):
            found = [fingerprint(x.lower().split(), shingle) for x in as_bytes(batch.column(text))]
            fp = pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), fp], names=[*(f.name for f in rest), "fp"])

    return docs.mapInArrow(run, T.StructType([*rest, T.StructField("fp", T.LongType())]))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def refinements(mask: int, bits: int) -> list[int]:
    """``mask`` with two of the ``bits + 2`` parts of its free bits added, for every choice of two."""
    free = [i for i in range(64) if not mask >> i & 1]
    step = -(-len(free) // (bits + 2))
    parts = [sum(1 << i for i in free[at:at + step]) for at in range(0, len(free), step)]
    return [mask | a | b for a, b in combinations(parts, 2)]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each 64-bit pattern in the reflected Gray sequence."""
    rank = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def index(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the root down, each as (pattern, mask): the bits a node adds to those of its parent.

    ``fps`` are in Gray order; the last level are the fingerprints themselves.
    """
    every = np.full(len(fps), ~np.uint64(0))
    levels = [(fps, every)]
    while len(levels[-1][0]) > 1:
        pattern, mask = levels[-1]
        at = np.arange(0, len(pattern), FANOUT)
        ones, some = np.bitwise_and.reduceat(pattern, at), np.bitwise_or.reduceat(pattern, at)
        shared = np.bitwise_and.reduceat(mask, at) & ~(ones ^ some)
        levels.append((ones & shared, shared))
    levels.reverse()
    down = [levels[0]]
    for (_, above), (pattern, mask) in zip(levels, levels[1:], strict=False):
        held = np.repeat(above, FANOUT)[: len(mask)]
        down.append((pattern & ~held, mask & ~held))
    return down


def links(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of all pairs of ``fps`` (in Gray order) with at most ``bits`` differing bits."""
    levels = index(fps)
    pattern, mask = levels[0]
    query = np.arange(len(fps))
    node = np.zeros(len(fps), np.int64)
    apart = np.bitwise_count((fps ^ pattern[0]) & mask[0]).astype(np.int64)
    for pattern, mask in levels[1:]:
        child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        query, apart = np.repeat(query, FANOUT), np.repeat(apart, FANOUT)
        real = child < len(pattern)
        query, apart, node = query[real], apart[real], child[real]
        apart = apart + np.bitwise_count((fps[query] ^ pattern[node]) & mask[node])
        near = apart <= bits
        query, apart, node = query[near], apart[near], node[near]
    one = query < node
    return query[one], node[one]


def forest(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for the fingerprints of a group that are linked to another and are not its root."""
    fps = fps[np.argsort(gray_rank(fps))]
    i, j = links(fps, bits)
    root = np.arange(len(fps))
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if np.array_equal(least, root):
            break
        root = least
    moved = root != np.arange(len(fps))
    return fps[moved], fps[root[moved]]


def _forests(bits: int):
    """For mapInArrow over rows (mask, val, fp) in the order of their keys: the forest of every group."""

    def run(batches: Batches) -> Batches:
        kept = [np.zeros(0, np.int64)] * 3
        for batch in [*_joined(batches), None]:
            if batch is None:
                mask, val, fp = kept
                whole = len(fp)
            else:
                mask, val, fp = (np.concatenate([k, batch.column(n).to_numpy()]) for k, n in zip(kept, ("mask", "val", "fp"), strict=True))
                whole = int(np.flatnonzero((mask != mask[-1]) | (val != val[-1]))[-1]) + 1 if len(fp) and ((mask != mask[-1]) | (val != val[-1])).any() else 0
            kept = [mask[whole:], val[whole:], fp[whole:]]
            mask, val, fp = mask[:whole], val[:whole], fp[:whole]
            if not whole:
                continue
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (val[1:] != val[:-1])])
            sizes = np.diff(np.r_[starts, whole])
            found = [forest(fp[a:a + n].view(np.uint64), bits) for a, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True)]
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _joined(batches: Batches) -> Batches:
    yield from batches


def linked(fps: DataFrame, bits: int = BITS, group: int = GROUP) -> DataFrame:
    """(a, b): links between different fingerprints of ``fps`` (column fp, distinct) that connect what all links connect."""
    spark = fps.sparkSession
    masks, ready = refinements(0, bits), []
    rows = fps.select(F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"), "fp")
    while True:
        rows = rows.withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
        if min(bin(~m & (1 << 64) - 1).count("1") for m in masks) <= 8:
            ready.append(rows)
            break
        rows = cut(rows)
        large = rows.groupBy("mask", "val").agg(F.count("*").alias("n")).where(F.col("n") > group).drop("n")
        large = cut(large)
        ready.append(rows.join(large, ["mask", "val"], "left_anti"))
        if large.isEmpty():
            break
        finer = {m: refinements(m, bits) for m in masks}
        keys = spark.createDataFrame([(_signed(m), [_signed(x) for x in xs]) for m, xs in finer.items()], "mask long, finer array<long>")
        masks = sorted({x for xs in finer.values() for x in xs})
        rows = rows.join(large, ["mask", "val"]).join(F.broadcast(keys), "mask").select(F.explode("finer").alias("mask"), "fp").distinct()
    keyed = reduce(DataFrame.unionByName, [r.select("mask", "val", "fp") for r in ready])
    keyed = keyed.repartition("mask", "val").sortWithinPartitions("mask", "val")
    return keyed.mapInArrow(_forests(bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b): equal roots if and only if connected.

    In each round every vertex points at the least of itself and its neighbours, in an order drawn anew by a hash. In such an
    order paths of pointers are short; they are shortened twice by following the pointer's pointer, and every vertex is
    merged into where it then points. Of a chain about a third of the vertices remain, whatever the order of their names, so
    the number of rounds is logarithmic in the longest chain. A round's rows never exceed the links before it, and pointers and roots are
    stored in each round, so no plan grows.
    """
    pairs = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    roots, nth = None, 0
    while not pairs.isEmpty():
        def drawn(v: str, nth: int = nth) -> Column:
            return F.struct(F.xxhash64(F.col(v), F.lit(nth)).alias("draw"), F.col(v).alias("v"))

        near = pairs.groupBy("a").agg(F.least(drawn("a"), F.min(drawn("b")))["v"].alias("to"))
        for _ in range(2):
            near = cut(near)
            ahead = near.select(F.col("a").alias("to"), F.col("to").alias("further"))
            near = near.join(ahead, "to").select("a", F.col("further").alias("to"))
        near = cut(near)
        one, two = near.select("a", F.col("to").alias("x")), near.select(F.col("a").alias("b"), F.col("to").alias("y"))
        merged = pairs.join(one, "a").join(two, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        pairs = cut(merged.distinct())
        if roots is None:
            roots = near.select(F.col("a").alias("v"), F.col("to").alias("root"))
        else:
            step = near.select(F.col("a").alias("root"), "to")
            roots = cut(roots.join(step, "root", "left").select("v", F.coalesce("to", "root").alias("root")))
        nth += 1
    if roots is None:
        return pairs.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots


def classes(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of ``prints`` (doc_id, fp)."""
    vertices = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(linked(vertices.select("fp"), bits)).withColumnRenamed("v", "fp")
    rooted = cut(vertices.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return cut(rooted.join(least, "root").select("fp", "component_id", "root"))


def near_copies(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = cut(fingerprints(docs.select("doc_id", "text"), shingle))
    return prints.join(classes(prints, bits).drop("root"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one for each class, with the columns of ``docs``."""
    slim = docs.select("doc_id", F.xxhash64(F.col("doc_id"), F.col("text")).alias("tie"), "text")
    prints = cut(fingerprints(slim, shingle))
    marked = prints.join(classes(prints, bits), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    stay = marked.groupBy("root").agg(F.min(order).alias("best")).select("best.doc_id", "best.tie")
    held = docs.select(F.xxhash64(F.col("doc_id"), F.col("text")).alias("tie"), F.col("doc_id").alias("id"), packed(docs).alias("row"))
    stay = stay.select(F.col("tie").alias("_tie"), F.col("doc_id").alias("_id"))
    kept = held.join(stay, (held["tie"] == stay["_tie"]) & held["id"].eqNullSafe(stay["_id"]), "left_semi")
    return kept.withColumn("nth", F.row_number().over(Window.partitionBy("tie", "id").orderBy(F.lit(0)))).where("nth = 1").select("row.*")
