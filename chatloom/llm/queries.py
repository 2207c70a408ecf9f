"""The operators' queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import (
    bpe,
    jaccard,
    language,
    mixing,
    neighbours,
    packing,
    phrases,
    quality,
    token_counts,
    token_files,
    warc,
    whitening,
    word_shuffle,
)

WORD_FILE, BYTE_FILE, RANK_FILE = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of whole texts: they go to workers in small batches, as one row can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_FILE))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_FILE))


def op3_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score_texts(table(spark, sf_dir, "documents"))


def op6_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_groups(table(spark, sf_dir, "documents"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_FILE))


def op8_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.store_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_FILE))


def op10_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return word_shuffle.digests(word_shuffle.round_trip(docs, public_tokenizers.path(RANK_FILE)))


def op11_fm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_best_fit_packing,
        op3_language_codes,
        op4_warc_chunks,
        op5_context_mixing,
        op6_signature_trees,
        op7_bpe_round_trip,
        op8_quality_votes,
        op9_token_files,
        op10_projected_neighbours,
        op11_fm_phrases,
        op12_qdwh_whitening,
        op13_distinct_word_bpe,
    )
}
