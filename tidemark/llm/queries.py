"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    attention_quality,
    chat,
    exact_dedup,
    hard_negatives,
    importance,
    jaccard_join,
    licenses,
    mixing,
    packing,
    pii,
    quality_rules,
    repeats,
    toxicity,
)
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: repeated rows of one id, source and size are told apart again."""
    taken = mixing.copies(table(spark, folder, "documents"))
    each = taken.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("nth"))
    return each.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate"
    )


def op2_certified_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "certified"
    )


def op3_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op4_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, folder, "documents"))


def op5_run_length_index(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.without_repeats(table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_prefix_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def op7_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = attention_quality.fit(docs, table(spark, folder, "labels"))
    scores = attention_quality.scored(docs, model)
    return scores.select("doc_id", attention_quality.held_out().alias("held_out"), "score", "predicted")


def op8_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.sql(
        "select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
    )
    back = chat.read_back(chat.format_conversations(rows.union(fixed)))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op10_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scores = toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    return scores.select("doc_id", attention_quality.held_out().alias("held_out"), "score", "predicted")


def op11_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scores = toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    return scores.select("doc_id", attention_quality.held_out().alias("held_out"), "score", "predicted")


def op12_zone_map_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(table(spark, folder, "embeddings"))


def op13_prefix_crc_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_entropy_mixing,
        op2_certified_rules,
        op3_bootstrapped_pii,
        op4_content_sort,
        op5_run_length_index,
        op6_prefix_tree_join,
        op7_attention_quality,
        op8_license_rules,
        op9_chat_formatting,
        op10_harmonic_packing,
        op11_subword_toxicity,
        op11_subword_toxicity,
        op12_zone_map_negatives,
        op13_prefix_crc_resampling,
    )
}


def oracles() -> dict[str, str]:
    sql = {"op2_certified_rules": quality_rules.judged_sql(), "op8_license_rules": licenses.scan_sql()}
    return sql | {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "sql").glob("*.sql"))}
