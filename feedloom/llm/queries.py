"""The operators as registered queries over the whole given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import (
    ctw, discriminant, fptree, graysimhash, heavydedup, licenses, linefreq, mixing, packing, skipchain, tagpaths, toxicity, wordruns,
)
from feedloom.llm.common import table
from feedloom.session import cut

#: The public tokenizer vocabulary that documents are packed with.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return skipchain.found(docs, skipchain.train(docs))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(discriminant.described(table(spark, sf_dir, "documents")))
    return discriminant.scored(rows, discriminant.train(rows, table(spark, sf_dir, "labels")))


RUNS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_context_tree_scores": lambda spark, sf_dir: ctw.scored(table(spark, sf_dir, "documents")),
    "op2_toxicity": toxicity_scores,
    "op3_line_frequency": lambda spark, sf_dir: linefreq.judged(table(spark, sf_dir, "documents")),
    "op4_source_mixing": lambda spark, sf_dir: mixing.mixed(table(spark, sf_dir, "documents")),
    "op5_license_scan": lambda spark, sf_dir: licenses.scanned(table(spark, sf_dir, "documents"), licenses.shipped()),
    "op6_tag_path_extraction": lambda spark, sf_dir: tagpaths.extracted(table(spark, sf_dir, "pages")),
    "op7_best_fit_packing": lambda spark, sf_dir: packing.pack(table(spark, sf_dir, "documents"), VOCABULARY),
    "op8_exact_dedup": lambda spark, sf_dir: heavydedup.assign(table(spark, sf_dir, "documents")),
    "op9_private_spans": private_spans,
    "op10_simhash_near_dedup": lambda spark, sf_dir: graysimhash.near_copies(table(spark, sf_dir, "documents")),
    "op11_quality_discriminant": quality_scores,
    "op12_word_runs": lambda spark, sf_dir: wordruns.reported(table(spark, sf_dir, "documents")),
    "op13_lexical_search": lambda spark, sf_dir: fptree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
}
SQL: dict[str, str] = {
    "op3_line_frequency": linefreq.ORACLE_SQL,
    "op4_source_mixing": mixing.ORACLE_SQL,
    "op8_exact_dedup": heavydedup.ORACLE_SQL,
    "op13_lexical_search": fptree.ORACLE_SQL,
}
