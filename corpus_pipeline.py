"""From raw documents to packed training windows: five stages, each written and reread as the next one's documents.

Every stage works on all rows that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import exact_dedup, language_id, mixing, ngram_join, packing
from chartloom.llm.common import quoted, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a learned language; ``lang`` only trains the centroids."""
    model = language_id.fit(language_id.training_rows(docs, F.lit(True), "doc_id", "text", "lang"))
    # the rows travel as one column, so none of theirs can clash with the prediction's
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), F.col("text").alias("__text"))
    return language_id.predict(rows, model).filter("NOT rejected").select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more: the document with the smallest id of each group stays."""
    return ngram_join.one_per_component(docs, n=5, threshold=(8, 10))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.default_tokenizer()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing", mixture),
    ("packing", packed),
]

#: Centroids and tokenizer ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
