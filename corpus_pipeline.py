"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Each stage is one operator of ``feedloom.llm`` and works on all that its predecessor kept. Columns besides doc_id, text and source pass
through every stage but the last, whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import graysimhash, heavydedup, mixing, packing, toxicity
from feedloom.llm.common import table
from feedloom.llm.queries import VOCABULARY
from feedloom.session import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts stay, unless toxic documents are the rule. Repeated rows stay or go together; a null id is never labelled.
    """
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the smallest id, nulls last, of repeated rows any one.

    Null and empty texts, and those of white space only, are apart: the first two are equal, the last equals one space.
    """
    return heavydedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: three-word shingles, two differing bits at most.

    Texts without words are one class. The smallest id stays, nulls last, then the smallest hash of the text.
    """
    return graysimhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, dealt to shards and shuffled within them.

    A part of a shard lies whole in one partition, so in one written file, its rows in the order of their keys. A null source is a
    source, null texts have no words and add none; repeated rows are documents of their own.
    """
    return mixing.shuffled(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their places in sequences of at most 4096 tokens.

    A null or empty text is the end token alone; a document that the mix repeats is packed as often.
    """
    return packing.pack(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_documents),
]

#: A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
