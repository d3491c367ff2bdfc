import hashlib
import shutil
import tempfile

import pytest
from helpers import STRANGE, documents, sentence
from pyspark.sql import functions as F
from stowage.llm import exact_dedup as X

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return (text or "").translate(LOWER)


def plain(rows):
    """Which identifier stays, how many rows there are, and the digest, for each row."""
    groups = {}
    for key, text in rows:
        groups.setdefault(normal(text), []).append(key)
    out = []
    for key, text in rows:
        own = groups[normal(text)]
        out.append((key, max((k for k in own if k is not None), default=None), len(own), hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [*STRANGE, (20, "Word"), (21, "WORD"), (22, "ÉCOLE"), (23, "école"), (24, "École"), (25, "K"), (26, "K"), (27, "long " * 700_000),
        (28, "LONG " * 700_000), *[(100 + k, "Copied Text") for k in range(300)], *[(500 + k, sentence(k % 40, 12)) for k in range(120)]]


@pytest.fixture(scope="module")
def folder(spark):
    path = tempfile.mkdtemp(prefix="exact-") + "/documents.parquet"
    docs = documents(spark, ROWS).withColumnsRenamed({"fingerprint": "digest", "node": "place", "accepted": "rows", "shard": "id"})
    docs.withColumn("_metadata", F.lit("x")).repartition(6).write.parquet(path)
    return path


def weak(text):
    return F.substring(F.sha2(text, 256), 1, 1)


@pytest.mark.parametrize("options", [{}, {"files": 1, "broadcast_rows": 0}, {"digest": weak}, {"digest": weak, "files": 2, "broadcast_rows": 0}],
                         ids=["one batch", "batches and shuffles", "digests that collide", "all"])
def test_like_plain(spark, folder, options):
    rows = X.deduplicated(spark, folder, **options).collect()
    expected = plain(ROWS)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in rows), key=repr) == sorted((e[:3] for e in expected), key=repr)
    if "digest" not in options:
        assert sorted(bytes(r.digest).hex() for r in rows) == sorted(e[3] for e in expected)
    # One row of each text stays, and it is one with the identifier that stays.
    stays = [r for r in rows if r.kept]
    assert len(stays) == len({normal(t) for _, t in ROWS}) and all(r.doc_id == r.keep_id for r in stays)


def test_state_goes_on(spark, folder):
    """Files that come later are met with what the state has; files it has taken are not taken again."""
    source, state = tempfile.mkdtemp(prefix="exact-"), tempfile.mkdtemp(prefix="exact-state-")
    documents(spark, [(1, "a"), (2, "b"), (3, "A")]).coalesce(1).write.mode("append").parquet(source)
    X.absorb(spark, source, state)
    X.absorb(spark, source, state)
    assert sorted(r["rows"] for r in X.entries(spark, state).collect()) == [1, 2]
    documents(spark, [(4, "B"), (0, "a"), (5, "c")]).coalesce(1).write.mode("append").parquet(source)
    X.absorb(spark, source, state)
    held = sorted((r.stays.id, r["rows"]) for r in X.entries(spark, state).collect())
    assert held == [(3, 3), (4, 2), (5, 1)]
    rows = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.decisions(spark, source, state).collect())
    assert rows == [(0, 3, 3, False), (1, 3, 3, False), (2, 4, 2, False), (3, 3, 3, True), (4, 4, 2, True), (5, 5, 1, True)]


def test_content_is_read_at_its_place(spark, folder):
    """The place that the state names has the text whose digest it keeps."""
    state = tempfile.mkdtemp(prefix="exact-state-")
    X.absorb(spark, folder, state)
    places = spark.read.schema("doc_id long, text string").parquet(folder).select("doc_id", X.normalised(F.col("text")).alias("text"), F.struct(
        "_metadata.file_path", "_metadata.row_index").alias("place"))
    found = X.entries(spark, state).join(places, F.col("stays.place") == F.col("place")).select("digest", "text", "doc_id", "stays.id").collect()
    assert len(found) == len({normal(t) for _, t in ROWS})
    assert all(hashlib.sha256(r.text.encode()).digest() == bytes(r.digest) and r.doc_id == r.id for r in found)


def test_single_files_and_empty_tables(spark, folder):
    path = tempfile.mkdtemp(prefix="exact-")
    documents(spark, [(1, "a"), (2, "A")]).coalesce(1).write.mode("overwrite").parquet(path + "/all")
    part = next(p for p in __import__("os").listdir(path + "/all") if p.endswith(".parquet"))
    shutil.copy(f"{path}/all/{part}", f"{path}/one.parquet")
    assert sorted((r.doc_id, r.keep_id) for r in X.deduplicated(spark, f"{path}/one.parquet").collect()) == [(1, 2), (2, 2)]
    documents(spark, []).write.parquet(path + "/none")
    none = X.deduplicated(spark, path + "/none")
    assert none.collect() == [] and none.columns == ["doc_id", "keep_id", "group_size", "kept", "digest"]
    assert X.decisions(spark, path + "/all", path + "/no-state").collect() == []


def test_no_python_runs_on_executors(spark, folder):
    state = tempfile.mkdtemp(prefix="exact-state-")
    X.absorb(spark, folder, state)
    plan = X.decisions(spark, folder, state)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
