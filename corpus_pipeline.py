"""From documents to packed sequences, stage by stage.

Each stage reads the whole table that the one before wrote, and its decisions take effect: all but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveylake.llm.common import settled, table
from surveylake.llm.exact_dedup import without_copies
from surveylake.llm.near_join import without_near_copies
from surveylake.llm.packing import DIGEST, pack_documents
from surveylake.llm.quality_rules import passing
from surveylake.llm.toxicity import Settings, below_threshold, learn


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that many documents of their source share."""
    return passing(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model fitted on labelled documents among them."""
    settings = Settings()
    return below_threshold(docs, learn(docs, table(spark, sf_dir, "labels"), settings), settings)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return without_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarity links connect."""
    return without_near_copies(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).select(DIGEST)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("best-fit packing", best_fit_packing),
]

#: SQL expresses neither the fitted model nor the packing. Tests compare the documents left by the quality and copy stages
#: with the operators' own verdicts; of toxicity they test that no row is new, of packing the number of documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written as Parquet and read again by the next.

    A stage's own tables are removed once its output is written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(spark, name.replace(" ", "-"), lambda: stage(spark, docs, sf_dir))
    return docs
