"""Exact deduplication with frequent digests split off.

A text's digest is the SHA-256 of its normalised form. Digests that a few texts share are grouped by an
ordinary shuffle. A digest that very many texts share would send them all to one task, so a Misra-Gries
summary (``approx_top_k``: mergeable counters, at most ``TRACKED`` of them, whatever the input's size) names
the frequent ones; their winner and exact count come from a partial aggregation, and at most ``HEAVY``
verified winners are broadcast, so that the rows of a frequent digest are decided where they are read.
Only DataFrame functions are used.

Defined results: a null text counts as empty, and empty texts are equal to each other. A null doc_id sorts
after all others; a group whose ids are all null has a null keep_id. ``assign`` marks a row as kept if its id is
the group's keep_id, so rows repeated with the same id and text are marked alike; ``drop_copies`` keeps exactly
one row of every group. An empty table gives an empty result. Other columns,
whatever their names, pass through ``drop_copies`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import SPACES, packed
from feedloom.session import cut

#: Counters of the frequency summary, and how many frequent digests are broadcast at most (about 64 bytes each).
TRACKED = 32768
HEAVY = 4096
#: Texts a digest must have, by exact count, to be decided by broadcast.
LEAST = 64

ORACLE_SQL = r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""


def digest(text):
    """Lower-case hex SHA-256 of the text with every run of white space replaced by one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ").cast("binary"), 256)


def winners(digests: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY, least: int = LEAST) -> DataFrame:
    """(digest, keep_id, group_size) of verified frequent digests: ``heavy`` rows at most.

    The summary works on the digest's first 60 bits. Every row of a candidate is counted again exactly, on the
    whole digest, so a summary's error never reaches a result: a digest it misses takes the ordinary path.
    """
    short = F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long")
    named = (
        digests.select(short.alias("short")).agg(F.expr(f"approx_top_k(short, {heavy}, {tracked})").alias("top"))
        .select(F.explode("top").alias("top"))
        .where(F.col("top.count") >= least)
        .select(F.col("top.item").alias("short"))
    )
    return (
        digests.withColumn("short", short).join(F.broadcast(named), "short", "left_semi")
        .groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") >= least)
        .orderBy(F.desc("group_size"), "text_sha256").limit(heavy)
    )


def assign(docs: DataFrame, **sizes: int) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = cut(docs.select("doc_id", digest(F.col("text")).alias("text_sha256")))
    heavy = cut(winners(digests, **sizes))
    decided = digests.join(F.broadcast(heavy), "text_sha256")
    same = Window.partitionBy("text_sha256")
    ordinary = digests.join(F.broadcast(heavy), "text_sha256", "left_anti").select(
        "text_sha256", "doc_id", F.min("doc_id").over(same).alias("keep_id"), F.count("*").over(same).alias("group_size"),
    )
    return decided.unionByName(ordinary).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame, **sizes: int) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with the columns of ``docs``.

    Copies of frequent texts go while the table is read; the rest meet in one shuffle, where a row that
    is not its task's first of a digest is dropped before it is sent.
    """
    digests = cut(docs.select("doc_id", digest(F.col("text")).alias("text_sha256")))
    heavy = F.broadcast(cut(winners(digests, **sizes)).select("text_sha256", "keep_id"))
    held = docs.select(digest(F.col("text")).alias("text_sha256"), F.col("doc_id").alias("id"), packed(docs).alias("row"))
    alive = held.join(heavy, "text_sha256", "left").where(F.col("keep_id").isNull() | (F.col("id") == F.col("keep_id")))
    first = Window.partitionBy("text_sha256").orderBy(F.col("id").asc_nulls_last())
    return alive.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
