"""Stages of the corpus pipeline: documents in, documents out, the last one packed pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontamination, line_frequency, packing, sanitisation, simhash
from martloom.llm.common import read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that their host repeats."""
    return line_frequency.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that reveal it replaced."""
    return sanitisation.without_personal_data(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, each with its sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
