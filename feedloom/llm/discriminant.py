"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

*Statistics.* Each whole text becomes ``len(NAMES)`` numbers: size, word length and its spread, the shares of capitals, digits,
marks, symbols and other bytes, words that are all capitals or bare marks, how often words, word pairs and lines repeat, how well the
text compresses, and the entropy of its bytes. Counts are taken as logarithms and shares as square roots, which brings them nearer to
normal; numbers that spread with the length of a text then do so less.

Statistics are taken once, and only they travel: labels are joined to them, and scores read them, never the texts again.

*Fitting.* A class is described by its number of documents, the sum of its vectors and the sum of their outer products. Those add
up over tasks, so all labelled documents are learned from, whatever their number, and only a few hundred numbers come to the driver.
Numbers are whole multiples of ``1 / UNIT`` and sums are exact integers: the order of tasks cannot change the model.

*Shrinkage.* In the coordinates of the pooled spread each class covariance is drawn ``POOL`` of the way to the pooled
covariance, and then to a multiple of the identity by the oracle-approximating amount, ``ROUND`` at least. So a
statistic that never varies within a class cannot decide alone, and a class with fewer rows than statistics still has a density.

*Scores.* The Cholesky factor of each covariance is computed once and kept as its inverse, so a batch's Mahalanobis
distances are one matrix product per class. The score is the logistic of the log-density difference plus the log ratio of the class
counts, the difference divided by ``HEAT``: the statistics are not normal, and undamped densities would be far too sure.

Defined results: a null or empty text has the statistics of a text without words and is scored like any other. A null label, or a
labelled id that no document has, teaches nothing. An id with both labels counts as the smaller one. Rows repeated are scored alike;
a labelled row that is repeated is learned as often as it occurs. With one class only, every score is 0 or 1; without any, one half.
An empty table gives an empty result. ``keep_good`` passes other columns through unchanged.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import Batches, as_bytes, fold

NAMES = (
    "words", "word_length", "word_spread", "capitals", "digits", "marks", "symbols", "others", "shouted", "bare", "marked",
    "new_words", "new_pairs", "same_next", "new_lines", "line_words", "compressed", "entropy",
)
#: Numbers are multiples of 1 / UNIT, at most MOST in size.
UNIT = 1 << 12
MOST = 64.0
#: Parts of a class covariance that come from the pooled one and, at least, from the identity.
POOL = 0.3
ROUND = 0.1
#: What log-density differences are divided by.
HEAT = 10.0
FOLDS, HELD = 4, 2
THRESHOLD = 0.7

_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b".,;:!?'\"()-"
_SYMBOLS = b"#*$%&|<>{}[]\\/^~_=+@"
_BARE = _MARKS + _SYMBOLS
_ENDS = _SYMBOLS + b"!?"
_OTHERS = bytes(range(128, 256))


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``NAMES``."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    body = b"".join(words)
    size = len(body)
    sizes = np.fromiter(map(len, words), np.int64, n)
    kinds = set(words)
    pairs = set(zip(words, words[1:], strict=False))
    lines = [line for line in text.split(b"\n") if line.strip()]
    counts = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    part = counts[counts > 0] / size
    share = {name: counts[np.frombuffer(chars, np.uint8)].sum() / size for name, chars in (
        ("capitals", _CAPITALS), ("digits", _DIGITS), ("marks", _MARKS), ("symbols", _SYMBOLS), ("others", _OTHERS),
    )}
    root = math.sqrt
    return [
        math.log1p(n), math.log(sizes.mean()), math.log1p(sizes.std()),
        *(root(share[k]) for k in ("capitals", "digits", "marks", "symbols", "others")),
        root(sum(1 for w in words if w.isupper() and len(w) > 1) / n),
        root(sum(1 for w in words if not w.strip(_BARE)) / n),
        root(sum(1 for w in words if w[-1] in _ENDS) / n),
        root(len(kinds) / n), root(len(pairs) / (n - 1)) if n > 1 else 1.0,
        root(sum(1 for a, b in zip(words, words[1:], strict=False) if a == b) / n),
        root(len(set(lines)) / len(lines)), math.log1p(n / len(lines)),
        root(len(zlib.compress(body, 1)) / (size + 16)), float(-(part * np.log2(part)).sum()) / 4,
    ]


def vectors(texts: Sequence[bytes]) -> np.ndarray:
    """One row of whole numbers, multiples of ``1 / UNIT``, per text."""
    rows = np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(NAMES))
    return np.rint(np.clip(rows, -MOST, MOST) * UNIT).astype(np.int64)


@dataclass
class Gaussian:
    """A class: log of its share, mean, inverse Cholesky factor of its covariance, and half the log determinant."""

    prior: float
    mean: np.ndarray
    whiten: np.ndarray
    half_log_det: float

    def log_density(self, rows: np.ndarray) -> np.ndarray:
        away = (rows - self.mean) @ self.whiten.T
        return -0.5 * np.einsum("ij,ij->i", away, away) - self.half_log_det


@dataclass
class Model:
    """Both classes, or the one score that every text gets."""

    classes: tuple[Gaussian, Gaussian] | None
    fixed: float = 0.5

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Scores of the rows of ``vectors``."""
        if self.classes is None or not len(rows):
            return np.full(len(rows), self.fixed)
        rows = rows / UNIT
        low, high = self.classes
        logit = (high.log_density(rows) - low.log_density(rows)) / HEAT + high.prior - low.prior
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def shrunk(cov: np.ndarray, pooled: np.ndarray, count: float) -> np.ndarray:
    """A class covariance, in pooled units, drawn to the pooled one and to the identity."""
    d = len(cov)
    cov = (1 - POOL) * cov + POOL * pooled
    level = np.trace(cov) / d
    square = float((cov * cov).sum())
    spread = (count + 1 - 2 / d) * (square - d * level * level)
    amount = ((1 - 2 / d) * square + (d * level) ** 2) / spread if spread > 0 else 1.0
    amount = min(1.0, max(ROUND, amount))
    return (1 - amount) * cov + amount * max(level, 1e-6) * np.eye(d)


def fit(sums: dict[int, tuple[int, list[int], list[list[int]]]]) -> Model:
    """From (count, sum, sum of outer products) of each class, in units of ``UNIT``."""
    sums = {k: v for k, v in sums.items() if v[0]}
    if len(sums) < 2:
        return Model(None, float(next(iter(sums))) if sums else 0.5)
    total = sum(n for n, _, _ in sums.values())
    means, covs = {}, {}
    for k, (n, first, second) in sums.items():
        # n * sum(x x') - sum(x) sum(x)' is exact in whole numbers, so nothing cancels.
        inner = [[n * s - a * b for s, b in zip(row, first, strict=True)] for row, a in zip(second, first, strict=True)]
        covs[k] = np.array([[x / (n * n) for x in row] for row in inner]) / UNIT**2
        means[k] = np.array([x / n for x in first]) / UNIT
    pooled = sum(covs[k] * (sums[k][0] / total) for k in sums)
    unit = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    across = np.outer(unit, unit)
    classes = {}
    for k, (n, _, _) in sums.items():
        lower = np.linalg.cholesky(shrunk(covs[k] / across, pooled / across, n))
        classes[k] = Gaussian(
            math.log(n / total), means[k], np.linalg.solve(lower, np.eye(len(unit))) / unit, float(np.log(np.diag(lower)).sum()),
        )
    return Model((classes[0], classes[1]))


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, vector): the statistics of every whole text."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("vector", T.ArrayType(T.IntegerType()))])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = vectors(as_bytes(batch.column("text"))).astype(np.int32)
            held = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(NAMES), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy().astype(np.int64).reshape(-1, len(NAMES))


def train(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fitted on all labelled rows of ``described`` outside the held-out fold; class sums are added up by Spark."""
    marks = labels.select("doc_id", F.col(label).alias("mark")).where(F.col("doc_id").isNotNull() & F.col("mark").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.min((F.col("mark") > 0).cast("int")).alias("mark"))
    learned = rows.where(fold(F.col("doc_id"), FOLDS) != HELD).join(marks, "doc_id").select("mark", "vector")
    d = len(NAMES)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("mark", "place", "value")])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            marked, found = batch.column("mark").to_numpy(), _rows(batch)
            for k in np.unique(marked):
                x = found[marked == k]
                value = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                columns = [np.full(len(value), k, np.int64), np.arange(len(value)), value]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=schema.names)

    added = learned.mapInArrow(run, schema).groupBy("mark", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    values: dict[int, list[int]] = {}
    for r in added.collect():  # two classes of 1 + d + d * d numbers
        values.setdefault(r["mark"], [0] * (1 + d + d * d))[r["place"]] = int(r["value"])
    return fit({k: (v[0], v[1:1 + d], [v[1 + d + i * d:1 + d + (i + 1) * d] for i in range(d)]) for k, v in values.items()})


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``described``: doc_id, held_out, score, predicted."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.score(_rows(batch)), pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, all columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.score(vectors(as_bytes(batch.column("text")))) >= THRESHOLD, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
