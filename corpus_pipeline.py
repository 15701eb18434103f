"""A training corpus from ``documents``: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the
shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import langid, packing, quality, simhash
from panelspark.llm.common import fold, table
from panelspark.llm.queries import tokenizer_path
from panelspark.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows drawn by importance resampling towards text labelled good; empty texts go."""
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return quality.keep_selected(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which one language has at least half the words; texts without a letter go."""
    model = langid.fit(docs, use=fold("doc_id", 4) != 2)
    return langid.keep_identified(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates (three-word shingles, at most 3 differing bits)."""
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of 4096 ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), window=4096, end_id=2)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage), ("packing", packing_stage)]

#: the stages train models and hash shingles, which SQL cannot express; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
