"""The training-data pipeline: five operators over the documents, in turn.

Each stage works on all that the one before it kept. ``run`` writes a stage's
rows to the shared folder and reads them again as the next one's documents, so
an executor that is lost costs the tasks of one stage at the most. What a stage
has read and what it wrote on its way are deleted once its rows are written.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketry.llm import mixing, neardup, packing, quality, toxicity
from basketry.llm.common import table
from basketry.llm.queries import TOKENIZER
from basketry.session import delete_tables, shared_dir, tables_end_with


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that importance resampling selects."""
    selected = quality.select(docs, table(spark, sf_dir, "labels"))
    return selected.where("selected").select(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are likelier toxic than not."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("toxic_score < 0.5").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return neardup.deduplicate(docs, words=5, threshold=80).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their targets; a document may come twice."""
    mixed = mixing.mix(docs, weights=(5.0, 2.0, 1.0), share=1.5, most=2)
    return mixed.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), end_id=0, size=1024)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("minhash_near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: SQL cannot express the trained stages; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs, before = table(spark, sf_dir, "documents"), None
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        with tables_end_with(spark):  # what a stage has written on its way
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_tables(spark, [before])
        docs, before = spark.read.parquet(path), path
    return docs
