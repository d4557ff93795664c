"""The registered queries' columns and types, their SQL, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import oracles, queries
from basketry.llm.common import table

SF_DIR = "/root/testdata/sf0.001"

#: What each query must have at least.
COLUMNS = {
    "op1_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op4_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op5_near_duplicates": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_near_vectors": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint",
    "op11_sentencepiece": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op12_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean",
    "op13_spelling": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_types(spark, name):
    types = dict(queries.QUERIES[name](spark, SF_DIR).dtypes)
    wanted = dict(c.split() for c in COLUMNS[name].split(", "))
    assert {c: types.get(c) for c in wanted} == wanted


@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    theirs = connection.sql(oracles.ORACLE_SQL[name])
    ours = queries.QUERIES[name](spark, SF_DIR).select(*theirs.columns)
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(theirs.fetchall(), key=repr)


def test_stages_keep_columns_and_the_run_is_their_sequence(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "toxicity", "minhash_near_dedup", "source_mix", "packing",
    ]
    docs = table(spark, SF_DIR, "documents")
    kept = [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, SF_DIR).cache()
        kept.append(after.count())
        if number < 3:  # filters
            assert after.columns == docs.columns and after.exceptAll(docs).count() == 0
            assert 0 < kept[-1] <= kept[-2]
        elif number == 3:
            assert after.columns == docs.columns
            assert after.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        else:
            per_copy = after.groupBy("doc_id").agg(
                F.sum("length").alias("n"), F.max("doc_tokens").alias("whole")
            )
            copies = docs.groupBy("doc_id").agg(F.count("*").alias("copies"))
            wrong = per_copy.join(copies, "doc_id").where("n != whole * copies").count()
            assert wrong == 0 and per_copy.count() == copies.count()
        docs = after
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(rows.select("doc_id", "start", "length", "ids_crc32").collect()) == sorted(
        docs.select("doc_id", "start", "length", "ids_crc32").collect()
    )
