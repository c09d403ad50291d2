"""The corpus pipeline: quality, toxicity, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on every document that the one before kept, and returns the columns of
``documents``; the last returns the token ids. NULL and empty texts, repeated rows and ties are handled as the
operators' docstrings say; an empty table passes through as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tekstmill.llm import bpe, forest, mixing, quality, toxicity
from tekstmill.llm.common import read_table, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    model = quality.learn_classifier(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, "source", "lang").filter("kept").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not call toxic."""
    lexicon = toxicity.learn_lexicon(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, lexicon).filter("predicted = 0").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return forest.drop_near_duplicates(docs).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_sources(docs).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_documents(docs, path, keys=["doc_id", "source"], decoded="decoded")
    digest = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return coded.select("doc_id", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids", digest)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

# Neither classifier nor the tokenizer can be put in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
