"""From raw documents to packed training sequences: five operators in a row, each on all that the last one kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import attention_quality, exact_dedup, jaccard_join, mixing, packing
from tidemark.llm.common import stage_of, store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(work: Stage) -> Stage:
    """A stage: what its operator stores is deleted when the next stage over the same folder begins.

    Each result must be written before that, as ``run`` does.
    """

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with stage_of(spark, sf_dir):
            return work(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the classifier accepts. The input's own texts are trained on, by the labels of the folder.

    Null and empty texts are judged as one empty passage, repeated rows alike. An empty table gives an empty table; other
    columns stay as they are, in this stage and the next three.
    """
    return attention_quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id: one row, also of repeated ones. Null equals empty, a null id is largest."""
    return exact_dedup.keep_first(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts the row with the smallest id, and the first of its rows without an id. Texts without words stay."""
    return jaccard_join.keep_one(docs)


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice. A null source is a source; sizes of null texts are 0."""
    return mixing.mixed(docs)


@_stage
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences; a null or empty text is its end id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packed_sequences),
]

# A trained model, the dual's solution and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents; what each returns is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
