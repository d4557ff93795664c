"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm import (
    euclid,
    forest,
    idfiles,
    licences,
    merkle,
    mixing,
    neardup,
    packing,
    pages,
    pieces,
    quality,
    spelling,
    toxicity,
)
from basketry.llm.common import in_folds, table
from basketry.llm.oracles import ORACLE_SQL  # noqa: F401
from basketry.session import shared_dir

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    extracted = pages.extract(table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", "n_chars")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        in_folds(F.col("doc_id"), [0]).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as coded id files, read back."""
    path = f"{shared_dir(spark)}/op3-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    idfiles.write_ids(docs, path, public_tokenizers.path(TOKENIZER), end_id=2)
    return idfiles.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return forest.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, by two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, threshold=80)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix to target weights takes."""
    planned = mixing.plan_mix(
        table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), share=1.5, most=2
    )
    return planned.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.size("mix_shards")).alias("taken"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by importance resampling: which are selected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.select(docs, table(spark, sf_dir, "labels")).drop("text")


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of each label at a cosine of 0.93 or more."""
    return euclid.near_vectors(table(spark, sf_dir, "embeddings"), least_cosine=0.93)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notices of all documents, a row each."""
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.fit(docs))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), end_id=0, size=1024)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces and back, with digests of ids and texts."""
    docs = table(spark, sf_dir, "documents")
    return pieces.recode(docs, public_tokenizers.path(PIECES)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "same_as_library",
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with every proof checked."""
    found = merkle.verify(merkle.manifest(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants of all words of all documents."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_main_text,
        op2_toxicity,
        op3_token_files,
        op4_nearest,
        op5_near_duplicates,
        op6_mixing,
        op7_quality,
        op8_near_vectors,
        op9_licences,
        op10_packing,
        op11_sentencepiece,
        op12_merkle,
        op13_spelling,
    )
}
