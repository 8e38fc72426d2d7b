"""From raw documents to packed sequences: five stages, each applied to all that the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfweave.llm.minhash import keep_first
from shelfweave.llm.mixing import mixed
from shelfweave.llm.packing import packed
from shelfweave.llm.passages import cut_passages
from shelfweave.llm.quality import keep_good
from shelfweave.llm.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), Scratch(spark, "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id."""
    return keep_first(docs, Scratch(spark, "near-dedup"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut."""
    return cut_passages(docs, Scratch(spark, "substring-dedup"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them."""
    return mixed(docs, Scratch(spark, "mixing"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), Scratch(spark, "packing"))


STAGES = [("quality classifier", quality), ("minhash near-dedup", near_dedup), ("substring dedup", substring_dedup), ("mixing to target weights", mixing), ("packing", packing)]
#: No SQL can state the trained classifier, the signatures, the alignment or the tokens; tests/llm compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, f"stage-{k}")
            if k:
                scratch.drop(f"stage-{k - 1}")
    return docs
