"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again. The first four return the
columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, minhash, packing, quality_classifier, substring_dedup
from tidemark.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learned from ``labels.quality`` predicts to be good."""
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.filter_documents(docs, model)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages of ``lang``, by a model learned from them."""
    return language_id.filter_documents(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return minhash.deduplicate(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that start earlier in the corpus too. A document of
    which nothing stays keeps its row, with an empty text."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = substring_dedup.remove_repeats(docs, 20, keep=rest, spaced=True)
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 token ids, placed in sequences of that length."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 1)


STAGES = [
    ("quality_classifier", quality),
    ("language_id", language),
    ("minhash", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("packing", pack),
]

#: Learned models and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
