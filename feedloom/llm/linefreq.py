"""Quality rules by cross-document line frequency.

Lines are normalised (lower case, digits as 0, white space as one space) and hashed. For every host, the ``source`` of a
document, a line's documents are counted: different texts, so that exact copies of one text count once.
Lines in more than ``limit`` texts of their host are removed from all its documents, and a document is
rejected as depleted if less than ``REMAIN`` of its words remains, or fewer than ``LEAST_WORDS`` words.
The limit is ``LIMIT`` texts for every host, whatever its size.

Counting starts within the document, so a line repeated in it is sent once; (host, line, text) triples are made distinct and counted
by partial aggregation, so a line of a third of all documents is a few numbers per task. Frequent lines meet their documents
in an equi-join that Spark may split where a line is hot.

Besides the method's verdict the base counts of the contract are computed in one pass over each whole text.

Defined results: a null or empty text has no words and fails the base rule. A null source is a host of its own. Rows repeated (equal id,
source and text) are judged alike and reported as often as they occur. An empty table gives an empty result. ``clean``
returns documents without their frequent lines and keeps all other columns.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import SPACES, WORDS, Batches, as_bytes, packed
from feedloom.session import cut

#: Texts of one host that may share a line.
LIMIT = 20
#: Part of a document's words, and number of them, that must remain.
REMAIN = 0.5
LEAST_WORDS = 10
#: Windows whose repetition the base rule counts, and its limit in percent.
REPEAT_WORDS = 5
REPEAT_PERCENT = 20

ORACLE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
    SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs
), windows AS (
    SELECT rid, i, ws[i:i + 4] AS five FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM words WHERE len(ws) >= 5)
), repeats AS (
    SELECT rid, count(DISTINCT i + o) AS n
    FROM (SELECT *, count(*) OVER (PARTITION BY rid, five) AS many FROM windows), range(0, 5) AS offsets(o)
    WHERE many > 1 GROUP BY rid
), lines AS (
    SELECT rid, source, t, unnest(string_split(t, chr(10))) AS raw FROM docs
), normals AS (
    SELECT *, trim(regexp_replace(regexp_replace(lower(raw), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM lines
), filled AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM normals WHERE line <> ''
), often AS (
    SELECT source, line FROM filled GROUP BY source, line HAVING count(DISTINCT t) > 20
), removed AS (
    SELECT rid, sum(n) AS n FROM filled f SEMI JOIN often o ON f.source IS NOT DISTINCT FROM o.source AND f.line = o.line GROUP BY rid
), dups AS (
    SELECT rid, count(*) - count(DISTINCT raw) AS n FROM filled GROUP BY rid
), counts AS (
    SELECT d.doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
           len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(u.n, 0) AS n_dup_lines,
           coalesce(r.n, 0) AS n_repeat_words, len(ws) - coalesce(x.n, 0) AS words_left
    FROM docs d JOIN words USING (rid) LEFT JOIN repeats r USING (rid) LEFT JOIN dups u USING (rid) LEFT JOIN removed x USING (rid)
), verdicts AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND words_left >= 10 AND words_left >= 0.5 * n_words AS kept, CAST(words_left AS BIGINT) AS words_left
FROM verdicts
"""

_SYMBOLS = re.compile(rb"[#*$%&|<>]")


def repeated_words(words: list[bytes], window: int = REPEAT_WORDS) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    kinds = len(number)
    if kinds == len(words):
        return 0
    key, held = ids[:n], kinds
    for i in range(1, window):
        if held * kinds >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            held = int(key.max()) + 1
        key, held = key * kinds + ids[i:i + n], held * kinds
    _, place, many = np.unique(key, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(many[place] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = text.split()
    chars = len(b"".join(words).decode("utf-8", "replace"))
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.split(None, 1):
            seen.add(line)
    return len(words), chars, len(_SYMBOLS.findall(text)), dup, repeated_words(words)


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, source, rid, text hash and the base counts of each document."""
    keep = ["doc_id", "source"]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.select(*keep, "text", F.xxhash64("text").alias("text_hash"))
    schema = T.StructType([*(f for f in rows.schema if f.name != "text"), *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [base_counts(x) for x in as_bytes(batch.column("text"))]
            counts = [pa.array([x[i] for x in found], pa.int64()) for i in range(len(names))]
            rest = [batch.column(f) for f in (*keep, "text_hash")]
            yield pa.RecordBatch.from_arrays([*rest, *counts], names=schema.names)

    return rows.mapInArrow(run, schema)


def normal(line: Column) -> Column:
    """What two lines must share to count as the same: empty for lines without a word."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACES, " "))


def document_lines(docs: DataFrame) -> DataFrame:
    """(source, text_hash, line_hash, words): every line with a word of every document."""
    texts = docs.select("source", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash"))
    lines = texts.select("source", "text_hash", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.select("source", "text_hash", normal(F.col("line")).alias("line"))
    return lines.where("line <> ''").select(
        "source", "text_hash", F.xxhash64("line").alias("line_hash"), F.regexp_count("line", F.lit(WORDS)).cast("long").alias("words"),
    )


def frequent_lines(lines: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, line_hash, texts) of lines in more texts of their host than the limit allows."""
    return lines.groupBy("source", "line_hash").agg(F.count("*").alias("texts")).where(F.col("texts") > limit)


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(source, text_hash, line_hash, words), one row per host, text and line; copies of a text agree on ``words``."""
    lines = document_lines(docs)
    each = docs.select("source", F.xxhash64("text").alias("text_hash")).groupBy("source", "text_hash").agg(F.count("*").alias("copies"))
    summed = lines.groupBy("source", "text_hash", "line_hash").agg(F.sum("words").alias("words"))
    each = each.select(F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), "copies")
    same = summed["source"].eqNullSafe(each["_source"]) & (summed["text_hash"] == each["_hash"])
    return summed.join(each, same).select("source", "text_hash", "line_hash", (F.col("words") / F.col("copies")).cast("long").alias("words"))


def judged(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, and words_left after the removal of frequent lines."""
    base = cut(with_base(docs))
    lines = cut(distinct_lines(docs))
    often = frequent_lines(lines, limit)
    often = cut(often.select(F.col("source").alias("_source"), F.col("line_hash").alias("_line")))
    gone = lines.join(often, lines["source"].eqNullSafe(often["_source"]) & (lines["line_hash"] == often["_line"]))
    gone = gone.groupBy("source", "text_hash").agg(F.sum("words").alias("removed"))
    gone = gone.select(F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), "removed")
    rows = base.join(gone, base["source"].eqNullSafe(gone["_source"]) & (base["text_hash"] == gone["_hash"]), "left")
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = (left < LEAST_WORDS) | (left < REMAIN * F.col("n_words"))
    return rows.withColumn("words_left", left).withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~depleted).alias("kept"), "words_left",
    )


def clean(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``docs`` without the frequent lines of their host; all columns stay."""
    lines = cut(distinct_lines(docs))
    often = frequent_lines(lines, limit).select(F.col("source").alias("_source"), F.col("line_hash").alias("_line"))
    gone = lines.join(often, lines["source"].eqNullSafe(often["_source"]) & (lines["line_hash"] == often["_line"]))
    gone = gone.groupBy("source", "text_hash").agg(F.collect_set("line_hash").alias("_gone"))
    gone = gone.select(F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), "_gone")
    held = docs.select(packed(docs).alias("row"), F.xxhash64("text").alias("hash"), F.col("source").alias("host"), "text")
    rows = held.join(gone, held["host"].eqNullSafe(gone["_source"]) & (held["hash"] == gone["_hash"]), "left")
    kept = F.filter(F.split("text", "\n"), lambda line: ~F.coalesce(F.array_contains("_gone", F.xxhash64(normal(line))), F.lit(False)))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return rows.withColumn("row", F.col("row").withField("text", text)).select("row.*")
