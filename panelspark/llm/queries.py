"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (balltree, bpe, chat, chunkbpe, embeddings, extraction, graphsearch, langid, packing, quality, simhash, toxicity,
                            wordruns)
from panelspark.llm.common import fold, table


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed ``public_tokenizers`` package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit(pages))


def op2_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return quality.resample(docs, model).withColumnRenamed("id", "doc_id")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations")).drop("spans")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_dedup(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), use=fold("doc_id", 5) != 0)
    out = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphsearch.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, use=fold("doc_id", 4) != 2)
    out = langid.identify(docs, model).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages", "shares")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), window=4096, end_id=2)


def op11_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunkbpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wordruns.periodic_runs(table(spark, sf_dir, "documents"), planted=True, outputs=False)
    return out.drop("runs", "collapsed").withColumnRenamed("id", "doc_id")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_quality_resampling, op3_simhash_dedup, op4_byte_bpe, op5_chat_perspectives, op6_embedding_dedup,
    op7_toxicity, op8_graph_search, op9_language_id, op10_packing, op11_chunk_bpe, op12_periodic_runs, op13_ranked_search, pipeline)}

ORACLES = {"op5_chat_perspectives": chat.ORACLE, "op13_ranked_search": balltree.ORACLE}
