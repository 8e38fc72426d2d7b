"""The registered queries of the numbered operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .alignment import alignment_digests
from .bpe import encoding_digests
from .mixing import mixture
from .packing import packed
from .embeddings import near_vectors
from .fingerprints import fingerprints
from .languages import languages
from .licences import licences
from .minhash import near_duplicates
from .passages import repeated_passages
from .quality import quality_scores
from .scratch import Scratch, reachable
from .spelling import spelling_variants
from .suffixes import repeated_bytes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(_table(spark, sf_dir, "documents"), Scratch(spark, "op1"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"), Scratch(spark, "op2"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_table(spark, sf_dir, "documents"), Scratch(spark, "op3"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), Scratch(spark, "op4"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op5"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), Scratch(spark, "op6"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark, "op7"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(_table(spark, sf_dir, "documents"), Scratch(spark, "op8"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment_digests(_table(spark, sf_dir, "documents"), a, b, Scratch(spark, "op12"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    return encoding_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_suffixes": op1_suffixes, "op2_fingerprints": op2_fingerprints, "op3_mixing": op3_mixing, "op4_packing": op4_packing, "op5_embeddings": op5_embeddings, "op6_quality": op6_quality,
    "op7_minhash": op7_minhash, "op8_licences": op8_licences, "op9_language": op9_language, "op10_passages": op10_passages,
    "op11_spelling": op11_spelling, "op12_alignment": op12_alignment, "op13_bpe": op13_bpe,
}
ORACLE: dict[str, str] = {}
