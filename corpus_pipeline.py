"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read
again as the ``docs`` of the next one. All but the last return the columns of ``documents``.

Rows without an id are kept by every stage: they cannot be named as copies. Of texts under one id each stays, unless they are near
copies; a repeated row gives one. A null or empty text is a document without lines. Extra columns, maps among them, pass through. Empty
tables give an empty result; without labels nothing is rejected, without benchmark items nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import decontaminate, line_dedup, packing, quality, simhash
from shopstream.llm.common import read_table, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows of ``docs``, accepts."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"), folds=5)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across them."""
    return line_dedup.with_lines_dropped(docs, min_docs=3, min_chars=20)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each_group(docs, words=4, max_bits=4)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"), containment=0.8)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of every document."""
    return packing.pack(docs, packing.word_count(F.col("text")), buckets=16, budget=65_536)


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the learned quality scores, XXH64 or the packing search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
