"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.llm import (
    bpe,
    decontaminate,
    lines,
    lmscore,
    minhash,
    negatives,
    quality,
    resample,
    sharding,
    spans,
    spotsigs,
    tokencount,
    warc,
)
from ledgerwave.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "keep")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("row.*", "removed")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.through_archives(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        decontaminate.items_digest().alias("items_sha256"),
        "contaminated",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")))
    return quality.scored(docs, model).select(
        "row.doc_id",
        quality.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("row.*", "removed")


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label=moved)


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.scores(table(spark, sf_dir, "documents"), lmscore.left_out())


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash,
        op2_line_dedup,
        op3_sharding,
        op4_warc,
        op5_decontamination,
        op6_quality,
        op7_token_counts,
        op8_bpe,
        op9_substring_dedup,
        op10_spotsigs,
        op11_hard_negatives,
        op12_lm_scores,
        op13_resample,
    )
}
