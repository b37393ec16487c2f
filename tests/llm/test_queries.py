"""The registered corpus queries and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from residua.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")
COLUMNS = {
    "op1": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op2": ["doc_id", "size", "source_size", "target", "taken"],
    "op3": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7": ["doc_id", "n_shingles", "component_id"],
    "op10": ["query_id", "rank", "vec_id", "score"],
    "op11": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op12": ["page_id", "host", "path", "rule", "word", "verdict"],
    "op13": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
}


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    out = QUERIES[name](spark, FOLDER)
    wanted = COLUMNS.get(name.split("_")[0], [])
    assert out.columns[: len(wanted)] == wanted
    whole = {"op9": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{FOLDER}/{whole}.parquet").count() * (4 if name.startswith("op13") else 1)
    assert 0 < out.count() <= rows if name.startswith("op8") else out.count() == rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql_twin(spark, name):
    con = duckdb.connect()
    for path in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {path.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{path}'")
    out = QUERIES[name](spark, FOLDER)
    assert out.columns[: len(COLUMNS.get(name.split("_")[0], []))] == COLUMNS.get(name.split("_")[0], [])
    wanted = con.execute(f"SELECT {', '.join(out.columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, out.collect()), key=str) == sorted(wanted, key=str)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0 and counts[4] == counts[5] > 0
    assert duckdb.execute(f"SELECT count(*) FROM '{tmp_path}/4/*.parquet' WHERE n_tokens <> len(ids)").fetchone() == (0,)
