"""Language-model scores by context-tree weighting over binary-decomposed bytes.

*Model.* A text is its lower-cased words joined by one space, then one end byte; every byte is eight binary decisions, most
significant bit first. Each decision (the bits already known of the byte) has its own context tree over the
previous bytes, to depth ``DEPTH``. A node holds how often training saw a 0 and a 1 there; its Krichevsky-Trofimov
estimate and its children are mixed with weight one half each, bottom up, so the root mixes all depths:
``Pw = Pkt / 2 + product(Pw of children) / 2``. Scoring walks from the root to the deepest context that training has seen and
mixes the nodes' estimates by their weights after training. The sum of the logarithms is the code length.

*Training at scale.* Nothing is held whole anywhere. Texts are dealt to blocks; a block's text becomes its distinct byte grams
(``DEPTH`` context bytes and the next byte) with training counts, cut into buckets by the two nearest context bytes, as
compact arrays. A bucket's arrays from all blocks are merged in rounds of at most ``FAN_IN``, so a task never holds more than
that many. A bucket has whole subtrees from depth two down; what the two levels above need is summed over
buckets: at most 256 * 255 rows. Each block's grams meet their bucket's model once more, in groups of at most ``ASKED`` bytes per
task, and go back to the block as log probabilities, so the work and the traffic follow the text, not the pairs of texts and
contexts. Word counts for the base score travel the same way, as 64-bit hashes in the place of grams.

*Training fold.* Documents with crc32(doc_id as text) mod 5 other than 1; all of their bytes are counted.

Defined results: a null or empty text is its end alone. A null doc_id counts as the empty text in the fold. Rows repeated are
trained on and scored as often as they occur. A context that training never saw ends the walk one level above. Without training
documents every decision has probability one half, and the base score is that of unseen tokens. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import as_bytes, fold
from feedloom.session import cut

#: Context bytes of a gram.
DEPTH = 6
END = b"\n"
#: Text bytes of a block, least and most buckets (of grams, and of words), arrays merged at once, and bytes asked of a model at once.
BLOCK_BYTES = 24_000_000
BUCKETS = 64
MOST_BUCKETS = 4096
FAN_IN = 256
ASKED = 64_000_000
FOLDS = 5
HELD_OUT = 1
#: Text of a block that is turned into grams at once.
STRIP = 1_000_000
#: Grams of strips that are kept before they are merged.
HELD = 2_500_000

_ALL = "block long, bucket int, keys binary, counts binary"


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def grams(text: bytes) -> np.ndarray:
    """One key per byte of ``text``: nearest context byte first, then farther ones, then the byte itself.

    A text starts after a context of end bytes.
    """
    byte = np.frombuffer(END * DEPTH + text, np.uint8)
    key = np.zeros(len(text), np.uint64)
    for back in range(1, DEPTH + 1):
        key = key << np.uint64(8) | byte[DEPTH - back:len(byte) - back]
    return key << np.uint64(8) | byte[DEPTH:]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.diff(np.r_[starts, len(keys)])


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grams with the same two nearest context bytes share a bucket."""
    near = keys >> np.uint64(8 * (DEPTH - 1))
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(buckets)


class Lookup:
    """Values by key, for keys that are all there: hashed layers, each holding the keys that the one before could not."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.kind = values.dtype
        self.layers = []
        while len(keys):
            bits = max(4, (2 * len(keys) - 1).bit_length())
            slot = self._slot(keys, len(self.layers), bits)
            held, stored = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, self.kind)
            held[slot] = keys
            placed = held[slot] == keys
            stored[slot[placed]] = values[placed]
            self.layers.append((bits, held, stored))
            keys, values = keys[~placed], values[~placed]

    @staticmethod
    def _slot(keys: np.ndarray, layer: int, bits: int) -> np.ndarray:
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * layer + 1)) % (1 << 64))
        return ((keys ^ keys >> np.uint64(32)) * odd >> np.uint64(64 - bits)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(keys), self.kind), None
        for layer, (bits, held, stored) in enumerate(self.layers):
            slot = self._slot(keys, layer, bits)
            hit = held[slot] == keys
            if todo is None:
                np.copyto(out, stored[slot], where=hit)
                todo = np.flatnonzero(~hit)
            else:
                out[todo[hit]] = stored[slot[hit]]
                todo = todo[~hit]
            keys = keys[~hit]
            if not len(keys):
                break
        return out


class _Block:
    """Distinct grams and words of a block with their training counts."""

    def __init__(self) -> None:
        self.strips = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        self.trained: Counter[bytes] = Counter()
        self.others: set[bytes] = set()

    def add(self, texts: list[bytes], trained: list[bool]) -> None:
        for mine in (True, False):
            strip, size = [], 0
            for text, train in zip(texts, trained, strict=True):
                if train != mine:
                    continue
                words = [*tokens(text), END]
                if mine:
                    self.trained.update(words)
                else:
                    self.others.update(words)
                strip.append(b" ".join(words[:-1]) + END)
                size += len(text)
                if size > STRIP:
                    self._count(strip, mine)
                    strip, size = [], 0
            self._count(strip, mine)

    def _count(self, strip: list[bytes], mine: bool) -> None:
        if strip:
            keys, counts = counted(np.concatenate([grams(x) for x in strip]))
            self.strips.append((keys, counts if mine else counts * 0))
            if sum(len(k) for k, _ in self.strips) > HELD:
                self.strips = [self.grams()]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        return summed(*(np.concatenate(x) for x in zip(*self.strips, strict=True)))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        names = [*self.trained, *(w for w in self.others if w not in self.trained)]
        counts = np.zeros(len(names), np.int64)
        counts[:len(self.trained)] = np.fromiter(self.trained.values(), np.int64, len(self.trained))
        return summed(np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names)), counts)

    def rows(self, buckets: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, keys, counts); the buckets of words follow those of grams."""
        out = []
        for base, (keys, counts) in ((0, self.grams()), (buckets, self.words())):
            place = keys % np.uint64(buckets) if base else _bucket(keys, buckets)
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(buckets + 1))
            for b in range(buckets):
                if ends[b] < ends[b + 1]:
                    at = order[ends[b]:ends[b + 1]]
                    out.append((base + b, keys[at], counts[at]))
        return out


def pack(values: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes first to last, which Spark's compression shrinks well."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _arrays(rows: list[tuple], block: int) -> pa.Table:
    return pa.table({
        "block": pa.array([block] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int32()),
        "keys": pa.array([pack(r[1]) for r in rows], pa.binary()), "counts": pa.array([r[2].tobytes() for r in rows], pa.binary()),
    })


def _keys(table: pa.Table) -> list[np.ndarray]:
    return [np.zeros(0, np.uint64), *(unpack(x) for x in table.column("keys").to_pylist() if x)]


def _read(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.zeros(0, kind), *(np.frombuffer(x, kind) for x in table.column(name).to_pylist() if x)]


def merged(parts: DataFrame, blocks: int) -> DataFrame:
    """(bucket, keys, counts): one row per bucket, training counts only, merged ``FAN_IN`` arrays at a time."""

    def merge(table: pa.Table) -> pa.Table:
        pair = summed(np.concatenate(_keys(table)), np.concatenate(_read(table, "counts", np.int64)))
        seen = pair[1] > 0
        return _arrays([(table.column("bucket")[0].as_py(), pair[0][seen], pair[1][seen])], table.column("block")[0].as_py())

    while True:
        parts = parts.withColumn("block", F.floor(F.col("block") / FAN_IN))
        parts = parts.groupBy("bucket", "block").applyInArrow(merge, _ALL)
        blocks = -(-blocks // FAN_IN)
        if blocks <= 1:
            return cut(parts.drop("block"))
        parts = cut(parts)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 1/2: Stirling's series after a shift by eight."""
    shift = np.ones_like(x)
    for i in range(8):
        shift = shift * (x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov block probability."""
    a, b = zeros.astype(np.float64), ones.astype(np.float64)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - math.log(math.pi)


class Level:
    """The nodes of one depth: ``node`` = context then decision (1 to 255), in order, with counts and weights."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.node, self.zeros, self.ones = node, zeros, ones
        kt = log_kt(zeros, ones)
        half = math.log(0.5)
        self.weighted = kt if below is None else np.logaddexp(half + kt, half + below)
        self.stop = np.ones_like(kt) if below is None else np.exp(np.minimum(0.0, half + kt - self.weighted))

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, zeros, ones) from sorted distinct (context, byte) keys with counts."""
        nodes, zeros, ones = [], [], []
        for bit in range(8):
            group = keys >> np.uint64(8 - bit)
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            one = np.where(keys >> np.uint64(7 - bit) & np.uint64(1), counts, 0)
            full = np.add.reduceat(counts, starts)
            high = np.add.reduceat(one, starts)
            first = keys[starts]
            prefix = np.uint64(1 << bit) | (first & np.uint64(255)) >> np.uint64(8 - bit)
            nodes.append(first >> np.uint64(8) << np.uint64(8) | prefix)
            zeros.append(full - high)
            ones.append(high)
        node = np.concatenate(nodes)
        order = np.argsort(node, kind="stable")
        return node[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]

    def find(self, node: np.ndarray) -> np.ndarray:
        """Positions of nodes; -1 where training has none."""
        if not len(self.node):
            return np.full(len(node), -1)
        at = np.minimum(np.searchsorted(self.node, node), len(self.node) - 1)
        return np.where(self.node[at] == node, at, -1)

    def upwards(self, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(parent, zeros, ones, sum of weights): the level above, whose contexts lack the farthest of ``top`` bytes."""
        parent = (self.node >> np.uint64(16) << np.uint64(8)) | self.node & np.uint64(255)
        order = np.argsort(parent, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(parent[order]) != 0]) if len(parent) else np.zeros(0, np.int64)
        sums = [np.add.reduceat(x[order], starts) if len(parent) else x for x in (self.zeros, self.ones, self.weighted)]
        return parent[order][starts], *sums


def subtree(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels DEPTH down to 2 of a bucket's contexts, deepest first."""
    levels = [Level(*Level.of(keys, counts), None)] if len(keys) else [Level(keys, counts, counts, None)]
    for depth in range(DEPTH, 2, -1):
        parent, zeros, ones, below = levels[-1].upwards(depth)
        levels.append(Level(parent, zeros, ones, below))
    return levels


def crown(near: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> list[Level]:
    """Levels 1 and 0 from the sums over all contexts of depth two, by nearest byte and decision."""
    one = Level(*near)
    root = Level(*one.upwards(1))
    return [one, root]


def log_chance(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """Natural logarithm of the probability of each gram's last byte. ``levels`` are deepest first, down to the root."""
    total = np.zeros(len(keys))
    context, byte = keys >> np.uint64(8), keys & np.uint64(255)
    for bit in range(8):
        prefix = np.uint64(1 << bit) | byte >> np.uint64(8 - bit)
        one = (byte >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        chance = np.full(len(keys), -1.0)
        for up, level in enumerate(levels):
            node = context >> np.uint64(8 * up) << np.uint64(8) | prefix
            at = level.find(node)
            known = at >= 0
            zeros, ones = level.zeros[at], level.ones[at]
            own = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1)
            stop = level.stop[at]
            mixed = np.where(chance < 0, own, stop * own + (1 - stop) * chance)
            chance = np.where(known, mixed, chance)
        total += np.log(np.where(chance < 0, 0.5, chance))
    return total


def dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """(block, doc_id, text, trained) and the number of blocks: rows dealt by a hash of id and text."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), (fold(F.col("doc_id"), FOLDS) != HELD_OUT).alias("trained"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks).cast("long"))), blocks


def model_parts(rows: DataFrame, blocks: int, buckets: int) -> DataFrame:
    """Each block's distinct grams and words in their buckets."""

    def run(table: pa.Table) -> pa.Table:
        block = _Block()
        for batch in table.to_batches(max_chunksize=1000):
            block.add(as_bytes(batch.column("text")), batch.column("trained").to_pylist())
        return _arrays(block.rows(buckets), table.column("block")[0].as_py())

    return cut(rows.groupBy("block").applyInArrow(run, _ALL))


def top_levels(model: DataFrame, buckets: int) -> list[Level]:
    """Levels 1 and 0, from at most 256 * 255 sums over all buckets."""

    def run(batches):
        for batch in batches:
            for keys, counts in zip(_keys(batch)[1:], _read(batch, "counts", np.int64)[1:], strict=True):
                parent, zeros, ones, below = subtree(keys, counts)[-1].upwards(2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parent.view(np.int64)), pa.array(zeros), pa.array(ones), pa.array(below)], names=["node", "zeros", "ones", "below"],
                )

    rows = model.where(F.col("bucket") < buckets).mapInArrow(run, "node long, zeros long, ones long, below double")
    got = rows.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).toArrow().sort_by("node")
    return crown((
        got.column("node").to_numpy().astype(np.uint64), got.column("zeros").to_numpy(), got.column("ones").to_numpy(), got.column("below").to_numpy(),
    ))


def answered(parts: DataFrame, model: DataFrame, buckets: int) -> DataFrame:
    """(block, keys, values): for each block's grams their log probability, for its words their training count.

    A bucket that is asked for more than ``ASKED`` bytes is answered by several tasks, each with its own copy of the bucket's model.
    """
    spark = parts.sparkSession
    top = spark.sparkContext.broadcast(top_levels(model, buckets))
    asked = parts.groupBy("bucket").agg(F.ceil(F.sum(F.octet_length("keys").cast("long")) / ASKED).alias("tasks"))
    asked = cut(asked)
    spread = parts.drop("counts").join(asked, "bucket").withColumn("part", F.pmod(F.col("block"), F.col("tasks"))).drop("tasks")
    copies = asked.join(model, "bucket", "left").select(
        "bucket", "keys", "counts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("part"),
    )

    def run(ask: pa.Table, have: pa.Table) -> pa.Table:
        bucket = (ask if ask.num_rows else have).column("bucket")[0].as_py()
        keys, counts = np.concatenate(_keys(have)), np.concatenate(_read(have, "counts", np.int64))
        levels = [*subtree(keys, counts), *top.value] if bucket < buckets else []
        # A gram that many blocks ask for is answered once.
        asks = [unpack(x) for x in ask.column("keys").to_pylist()]
        wanted = np.unique(np.concatenate([np.zeros(0, np.uint64), *asks]))
        if bucket < buckets:
            value = log_chance(wanted, levels).astype(np.float32)
        else:
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            value = np.where(keys[at] == wanted, counts[at], 0) if len(keys) else np.zeros(len(wanted), np.int64)
        values = [value[np.searchsorted(wanted, a)].tobytes() for a in asks]
        return pa.table({
            "block": ask.column("block"), "kind": pa.array([int(bucket >= buckets)] * ask.num_rows, pa.int32()),
            "keys": ask.column("keys"), "values": pa.array(values, pa.binary()),
        })

    groups = spread.groupBy("bucket", "part").cogroup(copies.groupBy("bucket", "part"))
    return groups.applyInArrow(run, "block long, kind int, keys binary, values binary")


def scored(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The number of buckets follows the text; it changes where models lie, not what they say.
    """
    rows, blocks = dealt(docs)
    buckets = buckets or min(MOST_BUCKETS, max(BUCKETS, blocks // 8))
    parts = model_parts(rows, blocks, buckets)
    model = merged(parts, blocks)
    totals = model.where(F.col("bucket") >= buckets).mapInArrow(_totals, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    seen, kinds = totals[0] or 0, totals[1] or 0
    log_all = math.log10(seen + 0.5 * (kinds + 1))
    answers = answered(parts, model, buckets)

    def run(mine: pa.Table, told: pa.Table) -> pa.Table:
        known = []
        for kind, store in ((0, np.float32), (1, np.int64)):
            some = told.filter(pc.equal(told.column("kind"), kind))
            keys, values = np.concatenate(_keys(some)), np.concatenate(_read(some, "values", store))
            known.append(Lookup(keys, values))
        chance, count = known
        lookup: dict[bytes, float] = {}
        n_tokens, n_known, base, score = [], [], [], []
        for text in as_bytes(mine.column("text")):
            words = tokens(text)
            new = [w for w in {*words, END} if w not in lookup]
            if new:
                number = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))
                lookup.update(zip(new, count[number].tolist(), strict=True))
            c = np.array([lookup[w] for w in words] + [lookup[END]])
            n_tokens.append(len(c))
            n_known.append(int((c > 0).sum()))
            base.append(float((np.log10(c + 0.5) - log_all).sum()))
            flat = b" ".join(words) + END
            total = 0.0
            for at in range(0, len(flat), STRIP):
                key = grams(flat[max(0, at - DEPTH):at + STRIP])[min(at, DEPTH):]
                total += float(chance[key].sum(dtype=np.float64))
            score.append(total / math.log(10))
        return pa.table({
            "doc_id": mine.column("doc_id"), "held_out": pc.invert(mine.column("trained")), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([seen] * mine.num_rows, pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
        })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _totals(batches):
    for batch in batches:
        counts = _read(batch, "counts", np.int64)[1:]
        yield pa.RecordBatch.from_arrays([pa.array([int(c.sum()) for c in counts], pa.int64()), pa.array([len(c) for c in counts], pa.int64())], names=["n", "v"])
