"""Properties of diffs, rollups and versions on generated catalogs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stowage.operators import diff as D, reports as P, rollup as R, versions as V, work as W
from stowage.functions.predicates import active

LINKS = "/links"
START = datetime(2024, 1, 1)
SCHEMA = ("filepath string, size long, ctime timestamp, mtime timestamp, dev long, ino long, nlink long")


def listing(spark, rows):
    return spark.createDataFrame([
        (f"/src/S{s}/1_2_3_B{b}/{sub}/f{i}.pod5", size, START + timedelta(hours=h), START + timedelta(hours=h + 1), 1, i, 1)
        for i, (s, b, sub, size, h) in rows.items()], SCHEMA)


def random_rows(rng, n, hot):
    """A third or more of the files may sit in one batch."""
    return {i: (rng.randrange(4), 0 if rng.random() < hot else rng.randrange(5), rng.choice(["raw", "x"]),
                rng.randrange(1, 50), rng.randrange(100)) for i in rng.sample(range(200), n)}


def changed_rows(rng, rows):
    out = {}
    for i, (s, b, sub, size, h) in rows.items():
        fate = rng.random()
        if fate < 0.2:
            continue
        if fate < 0.4:
            size, h = size + 1, rng.randrange(100)
        if 0.3 < fate < 0.5:
            sub = "moved"
        if 0.5 < fate < 0.6:
            b = (b + 1) % 5
        out[i] = (s, b, sub, size, h)
    for i in range(200, 200 + rng.randrange(20)):
        out[i] = (rng.randrange(6), rng.randrange(7), "raw", 3, rng.randrange(120))
    return out


def as_dict(frame, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in frame.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_deltas_equal_recompute(spark, seed):
    rng = random.Random(seed)
    old_rows = random_rows(rng, 80, hot=0.5)
    old = D.as_files(listing(spark, old_rows), LINKS)
    new = D.as_files(listing(spark, changed_rows(rng, old_rows)), LINKS)
    diff = D.snapshot_diff(new, old)
    kept = R.apply_deltas(R.membership(old), diff, new)
    assert as_dict(kept, "batch", "sample") == as_dict(R.membership(new), "batch", "sample")
    assert as_dict(R.batch_rollup(kept), "batch") == as_dict(R.batch_rollup(R.membership(new)), "batch")
    assert as_dict(R.sample_rollup(kept), "sample") == as_dict(R.sample_rollup(R.membership(new)), "sample")


@pytest.mark.parametrize("seed", range(2))
def test_applying_a_diff_gives_the_listing(spark, seed):
    rng = random.Random(seed)
    old_rows = random_rows(rng, 60, hot=0.3)
    columns = ["symlink", "filepath", "size", "fingerprint", "status"]
    old = D.as_files(listing(spark, old_rows), LINKS).select(*columns)
    new = D.as_files(listing(spark, changed_rows(rng, old_rows)), LINKS)
    diff = D.snapshot_diff(new, D.as_files(listing(spark, old_rows), LINKS))
    now = F.lit("2024-06-01").cast("timestamp")
    merged = V.merge_snapshot(old, new.select(*columns), "symlink", now)
    after = V.soft_delete(merged, diff.filter("change_type = 'deleted'"), now).filter(active())
    assert as_dict(after.select(*columns), "symlink") == as_dict(new.select(*columns), "symlink")


def test_same_listing_is_no_change(spark):
    files = D.as_files(listing(spark, random_rows(random.Random(1), 50, 0.4)), LINKS)
    diff = D.snapshot_diff(files, files)
    assert [r["change_type"] for r in diff.select("change_type").distinct().collect()] == ["unchanged"]
    assert R.contributions(diff).count() == 0 and D.change_log(diff).count() == 0


def test_fingerprints_ignore_row_order(spark):
    files = D.as_files(listing(spark, random_rows(random.Random(2), 60, 0.4)), LINKS)
    one = as_dict(R.batch_rollup(R.membership(files)), "batch")
    other = as_dict(R.batch_rollup(R.membership(files.orderBy(F.rand(3)).repartition(7))), "batch")
    assert one == other


def test_move_and_modification_at_once(spark):
    old = D.as_files(listing(spark, {1: (1, 1, "raw", 5, 1)}), LINKS)
    new = D.as_files(listing(spark, {1: (1, 1, "kept", 6, 1)}), LINKS)
    row = D.snapshot_diff(new, old).first()
    assert row["change_type"] == "moved_modified"
    assert [c["property"] for c in row["changed"]] == ["size", "fingerprint"]


def test_shallow_paths_are_set_aside(spark):
    rows = spark.createDataFrame([("/x/f.pod5", 1, START, START, 1, 1, 1)], SCHEMA)
    assert D.as_files(rows, LINKS).count() == 0
    assert D.unplaceable(rows, LINKS).count() == 1


@pytest.mark.parametrize("page_size", [1, 7, 1000])
def test_member_pages_hold_everything(spark, page_size):
    files = D.as_files(listing(spark, random_rows(random.Random(5), 60, 0.6)), LINKS)
    pages = R.member_map(files, "batch", page_size).collect()
    whole = {}
    for page in pages:
        assert not set(page["files"]) & set(whole.get(page["batch"], {}))
        whole.setdefault(page["batch"], {}).update(page["files"])
    expected = {}
    for row in files.collect():
        expected.setdefault(row["batch"], {})[row["symlink"]] = row["fingerprint"]
    assert whole == expected
    if page_size == 1000:
        assert {p["page"] for p in pages} == {0}


def test_report_lookup_is_containment(spark):
    names = ["B1", "B12", "2", "", "zz"]
    batches = spark.createDataFrame([(n,) for n in names], "batch string")
    files = ["/r/final_summary_B12.txt", "/q/final_summary_B1.txt", "/r/sequencing_summary_2.txt"]
    reports = P.find_reports(spark.createDataFrame([(f,) for f in files], "filepath string"))
    found = as_dict(P.batch_reports(batches, reports), "batch")
    for name in names:
        for kind in ("final_summary", "sequencing_summary"):
            hits = [f for f in files if kind in f and name and name in f.split("/")[-1]]
            assert found[(name,)][kind] == (min(hits) if hits else None)


@pytest.mark.parametrize("capacity", [{"SJF": 3, "LJF": 5}, {"SJF": 2000, "LJF": 1500}, {"SJF": 1, "LJF": 0}])
def test_admission_against_plain_python(spark, capacity):
    rng = random.Random(11)
    rows = [(f"t{i:03d}", rng.choice(["SJF", "LJF", "OTHER"]), rng.choice(["00:10", "01:00", "bad"]),
             rng.choice(["prepared", "prepared", "queued"]) if i % 20 == 0 else "prepared", rng.randrange(20))
            for i in range(200)]
    tasks = spark.createDataFrame(rows, "task_id string, sorting string, timeout string, status string, input_files_size long")
    minutes = {"00:10": 10, "01:00": 60}
    expected = set()
    for queue, size in capacity.items():
        slots = max(0, size - sum(r[1] == queue and r[3] == "queued" for r in rows))
        ready = [r for r in rows if r[1] == queue and r[3] == "prepared"]
        sign = -1 if queue == "LJF" else 1
        ready.sort(key=lambda r: (r[2] == "bad", sign * r[4] / minutes.get(r[2], 1) if r[2] != "bad" else 0, r[0]))
        expected |= {r[0] for r in ready[:slots]}
    assert {r["task_id"] for r in W.admit(tasks, capacity).collect()} == expected


def test_merge_modes_stamp_what_they_should(spark):
    base = spark.createDataFrame([("a", 1, None), ("b", 2, None)], "k string, v int, updated_at_DB timestamp")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    now = F.lit("2024-01-01").cast("timestamp")
    up = as_dict(V.merge_snapshot(base, new, "k", now), "k")
    assert {k[0]: r["v"] for k, r in up.items()} == {"a": 1, "b": 20, "c": 30}
    assert up[("a",)]["updated_at_DB"] is None and up[("b",)]["updated_at_DB"] is not None
    assert up[("b",)]["created_at_DB"] is None and up[("c",)]["created_at_DB"] is not None
    assert {k[0] for k in as_dict(V.merge_snapshot(base, new, "k", now, "update"), "k")} == {"a", "b"}
    assert {k[0] for k in as_dict(V.merge_snapshot(base, new, "k", now, "delete"), "k")} == {"a"}
    with pytest.raises(ValueError):
        V.merge_snapshot(base, new, "k", now, "replace")


def test_members_are_compared_before_they_are_made_distinct(spark):
    """Of both sides only what differs is grouped, so that a task holds no table of all members."""
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 2), (None, 3)], "batch string, link int")
    new = spark.createDataFrame([("a", 1), ("c", 4), ("c", 4), (None, 3)], "batch string, link int")
    out = D.member_differences(old, new, "batch", "link")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([
        ("b", 2, "removed"), ("c", 4, "added"), (None, 3, "added"), (None, 3, "removed")], key=repr)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2


def test_report_pieces_that_name_no_batch_are_not_grouped(spark):
    found = P.find_reports(spark.createDataFrame([("/r/final_summary_B1_run.txt",), ("/r/final_summary_B22_run.txt",)], "filepath string"))
    out = P.batch_reports(spark.createDataFrame([("B1",), ("B3",), (None,)], "batch string"), found)
    assert sorted(map(tuple, out.select("batch", "final_summary").collect()), key=repr) == sorted([
        ("B1", "/r/final_summary_B1_run.txt"), ("B3", None), (None, None)], key=repr)
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
