"""The package's queries against SQL, and the pipeline's stages on one another's results."""

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from stowage.llm.oracle import ORACLE
from stowage.llm.queries import QUERIES


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_registered():
    assert [n for n in QUERIES if n.startswith("op")] == [n for n in entry_module.queries() if n in QUERIES and n != "pipeline"]
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert set(ORACLE) <= set(QUERIES) and set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_like_sql(name, spark, sf_dir):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    frame, result = QUERIES[name](spark, sf_dir), connection.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _rows(frame.columns, map(tuple, frame.collect())) == _rows(columns, result.fetchall())


def test_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, keys = docs.columns, {r.doc_id for r in docs.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        rows = docs.collect()
        assert docs.columns == columns and {r.doc_id for r in rows} <= keys and len(rows) == len({r.doc_id for r in rows})
        if name == "quality":
            left = {r.doc_id for r in rows}
            bad = [k for k, r in labels.items() if r.toxic or not r.quality]
            good = [k for k, r in labels.items() if not r.toxic and r.quality]
            assert sum(k in left for k in bad) <= 0.05 * len(bad) and sum(k in left for k in good) >= 0.97 * len(good)
        if name == "line_dedup":
            assert {r.doc_id for r in rows} == keys
            assert all(r.n_chars == len(r.text) for r in rows if r.text != texts[r.doc_id])
        keys = {r.doc_id for r in rows}
    assert 0 < len(keys) < len(texts)
    pieces = corpus_pipeline.packed(spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == keys


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []
