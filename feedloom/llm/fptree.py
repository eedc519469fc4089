"""Ranked lexical search with document FP-trees.

1. *Vectors.* Each whole text is reduced to the terms that some item asks for, with their counts, and its number of terms. The
   vectors are stored; document frequencies, the number of texts and of all terms are added up by Spark.
2. *Trees.* Terms are ordered by falling document frequency. A task lays its vectors out as trees: each is the path of its
   terms in that order, and documents with a common beginning share it. A path without branches is one edge, and a subtree of
   at most ``LEAF`` documents is a leaf. A node keeps, of all documents below it, the largest count of every term, the least length
   norm m and the least doc_id.
3. *Search.* For an item, the largest counts and the least m of a node give a score that no document below it exceeds. A
   depth-first search visits the best child first and leaves out nodes whose bound cannot enter the item's ``TOP`` so far, of
   all trees that the task has searched. In leaves all scores are exact.
4. *Merge.* Each task gives ``TOP`` documents per item at most; the best of them are ranked, first in salted parts of an item.

Items are taken in blocks of about ``BLOCK_BYTES`` of their texts, so the terms that a task holds are bounded however many
items there are; a tree holds about ``CELLS`` counts. Documents are never compared with each other, and copies
of one text lie anywhere.

Scores are whole numbers: of a term with weight w = floor(1000 * ln((2N + 2) / (2df + 1))) and count tf it is
w * ((1000000000 * tf) div (1000 * tf + 8 * m)), with m = 25 + (75 * n * N) div L.

Defined results: a null or empty text has no terms and is never found; an item without terms, or whose terms nowhere occur, gives no rows.
Equal scores are ranked by doc_id, null last; repeated rows of documents are documents of their own. Repeated items are each answered, with
equal rows. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import Batches, as_bytes
from feedloom.session import cut

TOP = 10
#: Documents of a leaf at most, and counts that a tree holds at once.
LEAF = 32
CELLS = 4_000_000
#: Bytes of items that are searched together.
BLOCK_BYTES = 200_000
#: Parts that an item's candidates are ranked in first.
PARTS = 64
#: Stands for a null doc_id, after all others.
LAST = (1 << 63) - 1

#: ASCII letters in lower case and digits stay, other ASCII is a space, bytes from 128 on stay.
_FOLDED = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in bytes(range(256)).lower())

ORACLE_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), filled AS (
    SELECT rid, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM texts WHERE len(terms) > 0
), whole AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM filled
), asked AS (
    SELECT row_number() OVER () AS iid, item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark
), item_terms AS (
    SELECT iid, item_id, term, CAST(count(*) AS BIGINT) AS times
    FROM (SELECT iid, item_id, unnest(terms) AS term FROM asked) GROUP BY ALL
), counts AS (
    SELECT rid, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
    FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM filled) SEMI JOIN item_terms USING (term) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, whole GROUP BY term, docs
), scores AS (
    SELECT iid, item_id, rid, doc_id,
           CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
    FROM item_terms JOIN counts USING (term) JOIN weights USING (term), whole GROUP BY iid, item_id, rid, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLDED).split()


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Of each document with terms: doc_id, n, and the places in ``vocabulary`` of its terms with their counts."""
    sent = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("counts", ints)])

    def run(batches: Batches) -> Batches:
        place = sent.value
        for batch in batches:
            row, sizes, found, counts = [], [], [], []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                words = terms(text)
                if words:
                    many = Counter(words)
                    mine = many.keys() & place.keys()
                    row.append(i)
                    sizes.append(len(words))
                    found.append([place[t] for t in mine])
                    counts.append([many[t] for t in mine])
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(sizes, pa.int64()),
                pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Query:
    """One item: its terms' ranks, and their weights times how often it has them."""

    number: int
    ranks: np.ndarray
    weights: np.ndarray


class Tree:
    """The FP-tree of some documents, given as rows (document, rank, count) by document, with each document's m and id.

    Terms that none of them has are left out. Node 0 is the root.
    """

    def __init__(self, doc: np.ndarray, rank: np.ndarray, count: np.ndarray, m: np.ndarray, ids: np.ndarray):
        self.ranks, column = np.unique(rank, return_inverse=True)
        n, width = len(m), len(self.ranks)
        order = np.lexsort((column, doc))
        doc, column, count = doc[order], column[order], count[order]
        many = np.bincount(doc, minlength=n)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        paths = np.full((n, int(many.max(initial=0)) + 1), -1, np.int32)
        paths[doc, nth] = column
        # Paths in the order of their terms: bytes compare like the numbers they hold.
        keys = (paths + 1).astype(">u4")
        sort = np.array(sorted(range(n), key=lambda i: keys[i, :many[i]].tobytes()), np.int64)
        place = np.empty(n, np.int64)
        place[sort] = np.arange(n)
        self.m, self.ids = m[sort], ids[sort]
        self.counts = np.zeros((n, width), np.int64 if count.max(initial=0) > 2**31 - 1 else np.int32)
        self.counts[place[doc], column] = count
        self._grow(paths[sort])

    def _grow(self, paths: np.ndarray) -> None:
        self.low, self.high, self.children = [0], [len(paths)], [None]
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            low, high = self.low[node], self.high[node]
            if high - low <= LEAF:
                continue
            apart = np.flatnonzero(paths[low, depth:] != paths[high - 1, depth:])
            if not len(apart):
                continue  # equal paths: a leaf of any size
            depth += int(apart[0])
            cuts = [low, *(low + 1 + np.flatnonzero(np.diff(paths[low:high, depth]))).tolist(), high]
            first = len(self.low)
            self.low += cuts[:-1]
            self.high += cuts[1:]
            self.children += [None] * (len(cuts) - 1)
            self.children[node] = slice(first, first + len(cuts) - 1)
            todo += [(first + i, depth + 1) for i in range(len(cuts) - 1)]
        nodes = len(self.low)
        self.most = np.zeros((nodes, self.counts.shape[1]), self.counts.dtype)
        self.least_m, self.least_id = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        for node in range(nodes - 1, -1, -1):
            below = self.children[node]
            rows, m, ids = (self.counts, self.m, self.ids) if below is None else (self.most, self.least_m, self.least_id)
            part = slice(self.low[node], self.high[node]) if below is None else below
            self.most[node] = rows[part].max(axis=0)
            self.least_m[node], self.least_id[node] = m[part].min(), ids[part].min()

    def search(self, query: Query, best: Best) -> None:
        """Enter into ``best`` every document that belongs there."""
        at = np.searchsorted(self.ranks, query.ranks)
        here = np.flatnonzero(at < len(self.ranks))
        here = here[self.ranks[at[here]] == query.ranks[here]]
        if not len(here):
            return
        columns, weights = at[here], query.weights[here]

        def scores(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
            tf = counts[:, columns].astype(np.int64)
            return (1_000_000_000 * tf // (1000 * tf + 8 * m[:, None])) @ weights

        stack = [(slice(0, 1), scores(self.most[:1], self.least_m[:1]))]
        while stack:
            part, bound = stack.pop()
            nodes = np.arange(part.start, part.stop) if isinstance(part, slice) else part
            alive = best.admits(bound, self.least_id[nodes])
            for node, top in sorted(zip(nodes[alive].tolist(), bound[alive].tolist(), strict=True), key=lambda x: x[1]):
                below = self.children[node]
                if below is not None:
                    stack.append((below, scores(self.most[below], self.least_m[below])))
                elif best.admits(np.array([top]), self.least_id[node:node + 1])[0]:
                    rows = slice(self.low[node], self.high[node])
                    best.enter(scores(self.counts[rows], self.m[rows]), self.ids[rows])


class Best:
    """The best documents of one item so far, by falling score, then id."""

    def __init__(self) -> None:
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def admits(self, bound: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether documents with these scores and ids, at best, may be among the best."""
        if len(self.score) < TOP:
            return bound > 0
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & (ids < self.ids[-1]))

    def enter(self, score: np.ndarray, ids: np.ndarray) -> None:
        new = self.admits(score, ids)
        if new.any():
            score, ids = np.concatenate([self.score, score[new]]), np.concatenate([self.ids, ids[new]])
            order = np.lexsort((ids, -score))[:TOP]
            self.score, self.ids = score[order], ids[order]


def trees(batches: Batches, rank_of: np.ndarray, docs: int, words: int) -> Iterator[Tree]:
    """Trees of the vectors in ``batches``, each of about ``CELLS`` counts."""
    for batch in batches:
        n = batch.column("n").to_numpy()
        ids = np.array([LAST if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
        m = 25 + 75 * n * docs // words
        many = np.diff(batch.column("terms").offsets.to_numpy())
        doc = np.repeat(np.arange(len(n)), many)
        rank = rank_of[batch.column("terms").flatten().to_numpy()]
        count = batch.column("counts").flatten().to_numpy()
        ends = np.cumsum(many)
        at = 0
        while at < len(n):
            end = at + max(1, min(len(n) - at, CELLS // max(1, len(rank_of))))
            part = slice(int(ends[at - 1]) if at else 0, int(ends[end - 1]))
            if part.stop > part.start:
                yield Tree(doc[part] - at, rank[part], count[part], m[at:end], ids[at:end])
            at = end


def found(stored: DataFrame, queries: list[Query], rank_of: np.ndarray, docs: int, words: int) -> DataFrame:
    """(number, doc_id, score): the best documents of every item, of each task."""
    sent = stored.sparkSession.sparkContext.broadcast((queries, rank_of))
    schema = T.StructType([T.StructField("number", T.LongType()), stored.schema["doc_id"], T.StructField("score", T.LongType())])
    key = pa.int32() if stored.schema["doc_id"].dataType == T.IntegerType() else pa.int64()

    def run(batches: Batches) -> Batches:
        asked, ranks = sent.value
        best = [Best() for _ in asked]
        for tree in trees(batches, ranks, docs, words):
            for query, mine in zip(asked, best, strict=True):
                tree.search(query, mine)
        number = np.repeat([q.number for q in asked], [len(b.score) for b in best]).astype(np.int64)
        ids = np.concatenate([b.ids for b in best]) if best else np.zeros(0, np.int64)
        score = np.concatenate([b.score for b in best]) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array([None if x == LAST else x for x in ids.tolist()], key), pa.array(score)], names=schema.names
        )

    return stored.mapInArrow(run, schema)


def _block(docs: DataFrame, items: list[tuple[int, bytes]]) -> DataFrame:
    """(number, doc_id, score) of the items of one block."""
    asked = [(number, Counter(terms(text))) for number, text in items]
    vocabulary = sorted({t for _, many in asked for t in many})
    stored = cut(vectors(docs, vocabulary))
    total = stored.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    df = np.zeros(len(vocabulary), np.int64)
    # At most one row per term of the block.
    for r in stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    rank_of = np.empty(len(vocabulary), np.int64)
    rank_of[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    place = {t: i for i, t in enumerate(vocabulary)}
    queries = []
    for number, many in asked:
        mine = [t for t in many if df[place[t]]]
        if mine:
            at = np.array([place[t] for t in mine], np.int64)
            weights = np.array([many[t] * weight(total["docs"], int(df[place[t]])) for t in mine], np.int64)
            queries.append(Query(number, rank_of[at], weights))
    return found(stored, queries, rank_of, int(total["docs"]), int(total["words"] or 1))


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ``TOP`` best documents of every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    # Stored with their numbers, so that all blocks see the same ones.
    asked = cut(asked.select("*", F.monotonically_increasing_id().alias("number")))
    block = F.pmod(F.xxhash64("number"), F.lit(blocks))
    hits = None
    for nth in range(blocks):
        mine = [(r["number"], r["text"].encode()) for r in asked.where(block == nth).orderBy("number").collect()]
        part = _block(docs, mine)
        hits = part if hits is None else hits.unionByName(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    hits = hits.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for keys in (["number", "part"], ["number"]):
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= TOP)
    return asked.select("item_id", "number").join(hits, "number").select("item_id", "rank", "doc_id", "score")
