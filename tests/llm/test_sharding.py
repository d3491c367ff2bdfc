import collections
import tempfile

import pytest
from helpers import STRANGE, documents

from stowage.llm import sharding as H

SHARDS = [f"s{k}" for k in range(20)]


def test_shares_are_even_and_moves_few():
    table = H.lookup_table(SHARDS)
    counts = collections.Counter(table.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 20
    fewer = H.lookup_table(SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != 19) / len(table)
    assert moved < 0.12
    again = H.lookup_table(SHARDS[::-1])
    assert [SHARDS[k] for k in table] == [SHARDS[::-1][k] for k in again]


def test_table_by_turns():
    """Each shard's turn, step by step, on a small table."""
    table = H.lookup_table(["a", "b", "c"], 13)
    import xxhash
    orders = [[(xxhash.xxh64_intdigest(n, 1) % 13 + k * (xxhash.xxh64_intdigest(n, 2) % 12 + 1)) % 13 for k in range(13)] for n in "abc"]
    assert all(sorted(o) == list(range(13)) for o in orders)
    plain = {}
    while len(plain) < 13:
        for shard, order in enumerate(orders):
            free = next((s for s in order if s not in plain), None)
            if free is not None:
                plain[free] = shard
    assert [plain[k] for k in range(13)] == table.tolist()


def test_wrong_arguments():
    for shards, slots in ((SHARDS, 15), ([], 13), (["a", "a"], 13), (SHARDS, 13)):
        with pytest.raises(ValueError):
            H.lookup_table(shards, slots)


def test_placed(spark):
    docs = documents(spark, STRANGE)
    out = H.placed(docs, SHARDS)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    table = H.lookup_table(SHARDS)
    assert len(rows) == len(STRANGE) and all(r.shard == SHARDS[table[r.slot]] for r in rows)
    assert all(len({r.shard for r in rows if r.doc_id == key}) == 1 for key in (8, None))
    assert H.placed(documents(spark, []), SHARDS).collect() == []


def test_slots_are_hashes_of_the_keys(spark):
    docs = documents(spark, STRANGE).withColumnRenamed("shard", "Shard").withColumnRenamed("node", "SLOT")
    rows = H.placed(docs, SHARDS).collect()
    import xxhash

    for r in rows:
        known = xxhash.xxh64_intdigest(b"slot", 42)
        value = known if r.doc_id is None else xxhash.xxh64_intdigest(str(r.doc_id), known)
        assert r.slot == (value - (1 << 64) if value >> 63 else value) % H.SLOTS
    assert [c for c in rows[0].asDict()] == [*(c for c in docs.columns if c not in ("Shard", "SLOT")), "slot", "shard"]


def test_query(spark, sf_dir):
    from stowage.llm.queries import SHARDS as production, op10_sharding

    rows, table = op10_sharding(spark, sf_dir).collect(), H.lookup_table(production)
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.shard == production[table[r.slot]] for r in rows)


def test_written_shards(spark):
    path = tempfile.mkdtemp(prefix="shards-") + "/out"
    out = H.placed(documents(spark, STRANGE), SHARDS)
    H.write_shards(out, path, files=2)
    back = spark.read.parquet(path)
    assert sorted((repr(r.doc_id), r.shard) for r in back.collect()) == sorted((repr(r.doc_id), r.shard) for r in out.collect())
