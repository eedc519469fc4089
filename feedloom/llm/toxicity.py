"""Toxicity scores from subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with word-boundary marks) and of itself, all hashed into one table of
vectors, so an unseen misspelling shares most of its vectors with the word it comes from. A window of words is the average of
its words' bags (each word once), and a linear softmax over {clean, toxic} reads it. Vectors and softmax are trained together by
gradient descent. First all windows of a toxic document learn its label, then its two most toxic ones. The mean of the two most
toxic windows, in logits, answers for a document: one insult in a long text is not averaged away over the text, but an
insult that stands in one window only counts half, its neighbour the rest.

The softmax is linear in the average, so after training each table row is reduced to one number and a word's
number is the mean over its bag: the same scores without the vectors. Words' numbers are remembered per task.

Fitting takes at most ``SAMPLE`` labelled documents, chosen by a hash of their id (toxic and clean ones up to half each), and of
these at most ``SAMPLE_BYTES`` of text: the bound on what one task learns from. Texts above ``SHORT_BYTES`` come last, the
shorter first, so a long one never takes the place of others. A table row met in fewer than ``LEAST_DOCS`` documents of the sample counts
nothing: a word of so few labelled documents is judged by its more frequent n-grams only. Scoring covers whole texts of all rows.

Defined results: a null or empty text is one empty window, whose score is the softmax of the bias alone, held at most at
the share of toxic rows in the sample. A label that is null, or contradicts another label of the same document, counts as the larger
one. Of labelled rows that share an id the least text is learned from. Without labelled rows every score is 0. Repeated rows get equal scores. Other columns pass through
``keep_clean`` unchanged.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import Batches, as_bytes, fold, in_parts

#: Rows of the table of vectors, their width, and the n-gram lengths.
BUCKETS = 1 << 17
WIDTH = 8
GRAMS = (3, 4, 5, 6)
#: Words of a window. A word that is repeated in it counts once, and a shorter window is filled up with empty words.
WINDOW = 8
#: Weight of the toxic examples in training, of one.
TOXIC_PART = 0.4
#: Labelled documents, and bytes of their texts, used for fitting at most.
SAMPLE = 6_000
SAMPLE_BYTES = 24_000_000
#: Texts up to this size are taken in the order of the hash, longer ones after them.
SHORT_BYTES = 100_000
#: Gradient steps with all windows of toxic documents, then with the two most toxic ones of each.
STEPS = (30, 70)
#: Factor on a window's average, step size, and the gradient below which a row's steps shrink with its gradient: rare
#: features that fit by chance then hardly move.
SCALE = 16.0
RATE = 0.1
FLOOR = 1e-4
#: Table rows met in fewer training documents stay zero.
LEAST_DOCS = 8
#: Words whose n-grams are laid out at once in training.
STRIP = 20_000
#: Words that a worker remembers: those met lately, and as many from before. It changes nothing but time.
CACHE = 150_000
FOLDS = 5
#: Marks stripped from both ends of a word.
EDGE = string.punctuation
_EDGE_BYTES = EDGE.encode()


def word_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word's bag, laid end to end, and where each bag starts.

    Words are taken in groups of similar length, so one very long word does not widen the others.
    """
    texts = ["<" + w.decode("utf-8", "replace").lower().strip(EDGE).replace("\0", " ") + ">" for w in words]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    parts = []
    top = 2
    while len(size) and top < 2 * size.max():
        here = np.flatnonzero((size > top // 2) & (size <= top))
        if len(here):
            parts.append(_rows_of_class([texts[i] for i in here], here, size[here]))
        top *= 2
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, row = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(word, kind="stable")
    return row[order], np.searchsorted(word[order], np.arange(len(words)))


def _rows_of_class(texts: list[str], place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, table row) of every n-gram and of every whole word, by a rolling product over the characters."""
    wide = int(size.max())
    chars = np.array(texts, dtype=f"<U{wide}").view(np.uint32).reshape(len(texts), wide).astype(np.uint64)
    prime = np.uint64(0x100000001B3)
    whole = np.zeros(len(texts), np.uint64)
    for i in range(wide):
        whole = np.where(i < size, (whole ^ chars[:, i]) * prime + np.uint64(1), whole)
    words, rows = [place], [_bucket(whole)]
    for n in GRAMS:
        if wide < n:
            continue
        value = np.full((len(texts), wide - n + 1), n, np.uint64)
        for i in range(n):
            value = (value ^ chars[:, i:i + wide - n + 1]) * prime
        real = np.arange(wide - n + 1)[None, :] + n <= size[:, None]
        words.append(np.repeat(place, real.sum(axis=1)))
        rows.append(_bucket(value[real]))
    return np.concatenate(words), np.concatenate(rows)


def _bucket(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
    return (value >> np.uint64(64 - 17)).astype(np.int64)


@dataclass
class Model:
    """What scoring needs: a number for each table row, the bias, and the score of an empty text."""

    rows: np.ndarray
    bias: float
    empty: float


def fit(texts: list[bytes], toxic: list[int]) -> Model:
    """Vectors and softmax trained on labelled texts; equal input gives an equal model."""
    if not texts:
        return Model(np.zeros(BUCKETS, np.float32), -math.inf, 0.0)
    number: dict[bytes, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in t.split()], np.int64) for t in texts]
    word_docs = np.bincount(np.concatenate([np.zeros(0, np.int64), *(np.unique(d) for d in docs)]), minlength=len(number))
    bag, bag_word, bag_size, used = _bags(list(number), word_docs)
    y = np.array(toxic, np.float64)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    lengths = np.array([len(d) for d in docs])
    words = np.concatenate(docs) if lengths.sum() else np.zeros(0, np.int64)
    rng = np.random.default_rng(7)
    table = rng.normal(0, 0.1 / WIDTH, (BUCKETS, WIDTH))
    soft = np.zeros((2, WIDTH))
    soft[1], soft[0] = rng.normal(0, 1, WIDTH), rng.normal(0, 1, WIDTH)
    bias = np.array([0.0, math.log(share / (1 - share))])
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (table, soft, bias)]
    spans = np.maximum(1, -(-lengths // WINDOW))
    first = np.r_[0, np.cumsum(spans)]
    span = np.repeat(first[:-1], lengths) + (np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)) // WINDOW
    span, words = np.divmod(np.unique(span * len(number) + words), max(1, len(number)))
    bad = np.repeat(y, spans)
    even = np.where(bad > 0, TOXIC_PART / (np.repeat(spans, spans) * max(1.0, y.sum())), (1 - TOXIC_PART) / max(1.0, (1 - bad).sum()))
    for step in range(1, sum(STEPS) + 1):
        axis = soft[1] - soft[0]
        value = np.bincount(bag_word, (table @ axis)[bag], minlength=len(number)) / np.maximum(1, bag_size)
        logit = SCALE / WINDOW * np.bincount(span, value[words], minlength=first[-1]) + bias[1] - bias[0]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - bad) * even
        if step > STEPS[0]:
            best, two = _tops(logit, first)
            alone = np.zeros(first[-1])
            pooled = 1 / (1 + np.exp(-np.clip((logit[best] + logit[two]) / 2, -30, 30)))
            push = (pooled - 1) * TOXIC_PART / max(1.0, y.sum()) / 2
            np.add.at(alone, best, push)
            np.add.at(alone, two, push)
            error = np.where(bad > 0, alone, error)
        at_word = SCALE / WINDOW * np.bincount(words, error[span], minlength=len(number)) / np.maximum(1, bag_size)
        at_row = np.bincount(bag, at_word[bag_word], minlength=BUCKETS)[used]
        along = at_row @ table[used]
        grads = (at_row[:, None] * axis, np.stack([-along, along]), np.array([-error.sum(), error.sum()]))
        for p, g, (m, v), part in zip((table, soft, bias), grads, state, (used, ..., ...), strict=True):
            m[part] = 0.9 * m[part] + 0.1 * g
            v[part] = 0.999 * v[part] + 0.001 * g * g
            p[part] -= RATE * (m[part] / (1 - 0.9 ** step)) / (np.sqrt(v[part] / (1 - 0.999 ** step)) + FLOOR)
    axis = soft[1] - soft[0]
    rows = np.zeros(BUCKETS)
    rows[used] = SCALE / WINDOW * (table[used] @ axis)
    lean = float(bias[1] - bias[0])
    return Model(rows.astype(np.float32), lean, min(share, 1 / (1 + math.exp(-max(-30.0, min(30.0, lean))))))


def _bags(words: list[bytes], word_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words: table rows met in enough documents, the word of each, the full sizes of the bags, and the rows used.

    Words are taken in strips, twice: to count documents, then to keep what counts.
    """
    strips = [(at, words[at:at + STRIP]) for at in range(0, len(words), STRIP)]
    met, sizes = np.zeros(BUCKETS), []
    for at, strip in strips:
        bag, start = word_rows(strip)
        sizes.append(np.diff(np.r_[start, len(bag)]))
        met += np.bincount(bag, np.repeat(word_docs[at:at + len(strip)], sizes[-1]), minlength=BUCKETS)
    known, rows, owners = met >= LEAST_DOCS, [], []
    for (at, strip), size in zip(strips, sizes, strict=True):
        bag = word_rows(strip)[0]
        kept = known[bag]
        rows.append(bag[kept].astype(np.int32))
        owners.append(np.repeat(np.arange(at, at + len(strip), dtype=np.int32), size)[kept])
    none = [np.zeros(0, np.int32)]
    return np.concatenate(none + rows), np.concatenate(none + owners), np.concatenate([np.zeros(0, np.int64), *sizes]), np.flatnonzero(known)


def _tops(logit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of the two largest logits of each document's windows; twice the only one of a short document."""
    order = np.lexsort((-logit, np.repeat(np.arange(len(first) - 1), np.diff(first))))
    return order[first[:-1]], order[np.minimum(first[:-1] + 1, first[1:] - 1)]


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.young: dict[bytes, float] = {}
        self.old: dict[bytes, float] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Values of words not met lately; words that differ in case or outer marks share one."""
        cores = {w: w.lower().strip(_EDGE_BYTES) for w in words}
        new = list({c for c in cores.values() if c not in self.young and c not in self.old})
        if new:
            bag, start = word_rows(new)
            sums = np.add.reduceat(self.model.rows[bag], start, dtype=np.float64) / np.diff(np.r_[start, len(bag)])
            self.young.update(zip(new, sums.tolist(), strict=True))
        for w, core in cores.items():
            self.young[core] = self.young[w] = self.young[core] if core in self.young else self.old[core]

    def score(self, text: bytes) -> float:
        words = text.split()
        if not words:
            return self.model.empty
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = []
        for w in {w for w in words if w not in young}:
            if w in old:
                young[w] = old[w]
            else:
                missing.append(w)
        if missing:
            self._learn(missing)
        known = young
        logits = sorted(sum(known[w] for w in set(words[at:at + WINDOW])) for at in range(0, len(words), WINDOW))[-2:]
        logit = sum(logits) / len(logits) + self.model.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))) if math.isfinite(logit) else 0.0


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fitted on labelled documents outside fold 0, at most ``SAMPLE`` of them, in the order of a hash of their id."""
    marks = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).where(fold(F.col("doc_id"), FOLDS) != 0)
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    chosen = marks.where(F.col("doc_id").isNotNull()).where(fold(F.col("doc_id"), FOLDS) != 0)
    share = [chosen.where(F.col("toxic") > 0), chosen.where(F.col("toxic") <= 0)]
    chosen = share[0].orderBy(order).limit(SAMPLE // 2).unionByName(share[1].orderBy(order).limit(SAMPLE // 2))
    found = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn("order", order)
    size = F.octet_length("text")
    upto = Window.partitionBy("toxic").orderBy(F.greatest(size, F.lit(SHORT_BYTES)), "order", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("upto", F.sum(size.cast("long")).over(upto)).where(F.col("upto") <= SAMPLE_BYTES // 2)

    def learn(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
        model = fit(as_bytes(sample.column("text")), [int(x > 0) for x in sample.column("toxic").to_pylist()])
        return pa.table({"rows": [model.rows.tobytes()], "bias": [model.bias], "empty": [model.empty]})

    # One task of an executor learns from the bounded sample; only the model comes to the driver.
    sample = found.select("order", "doc_id", "text", "toxic").groupBy(F.lit(0).alias("all"))
    got = sample.applyInArrow(learn, "rows binary, bias double, empty double").first()
    return fit([], []) if got is None else Model(np.frombuffer(bytes(got.rows), np.float32), got.bias, got.empty)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = docs.schema["doc_id"]
    schema = T.StructType([key, T.StructField("score", T.DoubleType())])

    def run(batches: Batches) -> Batches:
        scorer = Scorer(sent.value)
        for batch in in_parts(batches, "text"):
            score = pa.array([scorer.score(x) for x in as_bytes(batch.column("text"))], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose score is below one half."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        scorer = Scorer(sent.value)
        for batch in in_parts(batches, "text"):
            yield batch.filter(pa.array([scorer.score(x) < 0.5 for x in as_bytes(batch.column("text"))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
