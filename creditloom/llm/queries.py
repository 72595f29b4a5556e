"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    ann, bpe, jaccard, lloyd, main_text, mixing, neardup_vectors, pii, quality, runs, sharding, suffixes, warc,
)
from .common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 16


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.record_summary(warc.archive_pages(table(spark, sf_dir, "pages")))


def op2_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(spark, table(spark, sf_dir, "documents"), TOKENIZER)


def op3_collision_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


def op4_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)


def op5_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogate_documents(table(spark, sf_dir, "documents"))


def op7_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op10_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(table(spark, sf_dir, "documents"))


def op12_scored_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf_dir, "pages"))


def op13_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.compressed_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_warc_chunks,
        op2_bpe_words,
        op3_collision_neardup,
        op4_token_groups,
        op5_rule_quality,
        op6_surrogates,
        op7_suffix_intervals,
        op8_kd_shards,
        op9_posting_lists,
        op10_pfair_mix,
        op11_periodic_runs,
        op12_scored_regions,
        op13_resident_lloyd,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op12_scored_regions": main_text.oracle_sql(),
        "op13_resident_lloyd": lloyd.oracle_sql(),
    }
