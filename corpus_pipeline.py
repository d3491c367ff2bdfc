"""From documents to packed sequences: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stowage.llm import decontamination, line_dedup, packing, quality, simhash
from stowage.llm.common import stored, table


def grade() -> Column:
    """The grade of a rating, from worst: 0 toxic, 1 poor, 2 good."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good with a probability of one half or more."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), grade())
    return quality.graded(docs, model, at_least=2).filter("accepted").select(*docs.columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of three lines or more that an earlier one has."""
    cut = line_dedup.dedup_lines(docs, count="_removed")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.unique_documents(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality", good),
    ("line_dedup", without_repeated_passages),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Grading, similarity and token ids are not SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
