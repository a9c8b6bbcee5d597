"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before kept, as Parquet, and its decisions take effect: documents that a
filter rejects are gone for the later stages. The first four return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxelyard.llm import decontaminate, exact_dedup, near, packing, quality, simhash
from voxelyard.llm.shared import Scratch, scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents between the perplexity quantiles of their language stay."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of equal texts, the document with the smallest id stays."""
    return exact_dedup.distinct_documents(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8's fingerprint links on five-word shingles, with MinHash's candidates beside them, each checked on the
    whole texts: of each component of near copies (Jaccard of 0.8 or more), the document with the smallest id
    stays."""
    return simhash.representatives(docs, near.grouped(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents with a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: a row per piece of the packed sequences."""
    import public_tokenizers

    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The quality model and the fingerprints can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again, over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage{k}")
        with Scratch() as own:
            stage(spark, docs, sf_dir).write.parquet(path)
        own.free()
        docs = spark.read.parquet(path)
    return docs
