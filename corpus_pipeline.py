"""The corpus pipeline: quality, near copies, benchmark leaks, secrets, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps of ``docs``; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quantloom.llm.common import forget, saved
from quantloom.llm.decontaminate import drop_leaks
from quantloom.llm.jaccard_join import keep_one_per_component
from quantloom.llm.quality import keep_quality
from quantloom.llm.secret_scan import redact_secrets
from quantloom.llm.sentencepiece_codec import encode_texts


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts."""
    return redact_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids join the columns."""
    return encode_texts(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("SentencePiece encoding and decoding", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages make of ``documents``. Each stage's table is deleted once the next one is written.

    Null texts count as empty, rows without doc_id are near copies of nothing, of rows with one doc_id one stays,
    further columns of any name are kept, and an empty table gives no rows; each operator's docstring says more.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"stage{i}")
            if i:
                forget(before)
    return docs
