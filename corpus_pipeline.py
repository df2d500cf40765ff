"""Training-corpus pipeline: quality filter, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all the previous one kept. All but the last return the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketframe.llm import decontam, packing, pii, quality, simhash
from marketframe.llm.common import read
from marketframe.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Null and empty texts are judged like others, repeated rows alike;
    texts of any length are read whole; columns of any name stay; an empty table stays empty."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of the smallest id. Texts without words are one group; of repeated rows
    one stays; a null id is kept only where its group has no other; columns of any name stay."""
    return simhash.deduplicated(docs, shingle=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. Null and empty texts have no window and stay, repeated rows
    go or stay together; columns of any name stay."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets. Null texts stay null; ``n_chars`` follows the text."""
    return pii.redacted(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens. A null or empty text is its end mark;
    repeated rows are packed each; longer texts are cut into pieces; an empty table gives no piece."""
    return packing.packed(docs, room=2048)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit", best_fit),
]

# learned scores, XXH64 fingerprints and a tokenizer: SQL cannot express the stages; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    out = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return done
        done.write.parquet(f"{out}/{k}-{name}")
        docs = spark.read.parquet(f"{out}/{k}-{name}")
    return docs
