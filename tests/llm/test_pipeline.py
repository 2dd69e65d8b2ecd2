"""The registered queries and the pipeline, on the smallest tables and on edge cases."""

import os
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from agentlake.llm import mixing, oracles, queries
from agentlake.llm.labelled import fold_of
from agentlake.llm.quality_model import train_quality
from tests.compare import bag, duckdb_over, spark_types
from tests.llm.plain import EDGE_TEXTS, WORD, docs_of, plain_components, plain_found, random_texts
from tests.llm.test_token_files import plain_ids

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_equal_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    expected = duckdb_over(SF_DIR).execute(oracles.ORACLES[name])
    assert spark_types(df) == {d[0]: str(d[1]) for d in expected.description}
    assert bag(df.columns, df.collect()) == bag([d[0] for d in expected.description], expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op11_spelling"}))  # has words
def test_queries_return_every_row(spark, name):
    table, key = {"op8_html_extract": ("pages", "page_id"), "op13_whitening": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    rows = queries.QUERIES[name](spark, SF_DIR)
    rows = rows.where({"op12_packing": "piece = 0", "op13_whitening": "component = 1"}.get(name, "true"))
    ids = sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
    assert sorted(r[key] for r in rows.collect()) == ids


def plain_pipeline(model, docs, items):
    """(doc_id, text) rows in, (doc_id, start, n_tokens, crc) rows out."""
    scores = model.scores(pa.array([t for _, t, _ in docs], pa.large_string()))
    docs = [d for d, s in zip(docs, scores) if s >= 0.3]
    named = plain_components({i: t for i, t, _ in docs})
    docs = [d for d in docs if named[d[0]][1] == d[0]]
    docs = [d for d, found in zip(docs, plain_found([t for _, t, _ in docs], items)) if not found[1]]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [d[0] for d in docs], "text": pa.array([d[1] for d in docs], pa.string()), "source": pa.array([d[2] for d in docs], pa.string())}))
    texts, rows = {d[0]: d[1] for d in docs}, []
    for doc_id, size, _, _, taken in con.execute(mixing.ORACLE).fetchall():
        if taken:
            rows += [(doc_id, texts[doc_id])] * (taken // size)
            rows += [(doc_id, " ".join(WORD.findall(texts[doc_id])[: taken % size]))] * (taken % size > 0)
    rows.sort(key=lambda r: (r[0], (xxhash.xxh64_intdigest(r[1], seed=42) + (1 << 63)) % (1 << 64), r[1]))  # as signed numbers
    out, start = [], 0
    for (doc_id, _), ids in zip(rows, plain_ids([t for _, t in rows])):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pipeline_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = train_quality(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"), lambda d: fold_of(d, 5) == 0)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    expected = plain_pipeline(model, [tuple(r) for r in docs.select("doc_id", "text", "source").orderBy("doc_id").collect()], items)
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(expected) and len(expected) > 100


def test_stages_on_edge_cases(spark, tmp_path):
    folder = str(tmp_path)
    texts = random_texts(60, seed=4) + EDGE_TEXTS + EDGE_TEXTS[-3:]
    docs = docs_of(spark, texts, [*range(len(texts) - 3), 3, None, None]).withColumn("kept", F.lit(1))
    spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, texts[5]), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, some, folder)
            assert kept.columns == corpus_pipeline.COLUMNS, name
            assert kept.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
            kept.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, some, folder).count() == some.count()


def test_one_row_of_each_group_stays(spark):
    docs = docs_of(spark, ["a b c d e f", "A b c d e f", "x", "x", None, "y"], [4, 2, 6, 6, 7, None])
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "")
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "6", "7", "None"]
