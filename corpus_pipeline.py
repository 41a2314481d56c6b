"""The corpus pipeline: each stage's rows are written as Parquet and read again by the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import stages
from martloom.llm.common import read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality),
    ("simhash_near_dup", stages.near_duplicates),
    ("decontamination", stages.decontaminate),
    ("personal_data", stages.personal_data),
    ("packing", stages.pack),
]
# Tokenizing and packing have no SQL counterpart; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; the last stage's rows."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
