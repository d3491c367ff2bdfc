"""What the planner makes of the operators: pruning, pushdown, limits, partial aggregation."""

import os
import re

import pytest
from pyspark.sql import functions as F

from stowage import views as V
from stowage.operators import diff as D, events as E, rollup as R, versions, work as W
from stowage.sources import rules, tables


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The derived tables as parquet, so that scans show what reaches them."""
    root = str(tmp_path_factory.mktemp("tables"))
    for name in ("samples", "tasks", "files_now"):
        getattr(V, name)(spark, sf_dir).write.parquet(f"{root}/{name}")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(frame):
    return [set(re.findall(r"(\w+)#", s)) for s in re.findall(r"FileScan parquet \[(.*?)\]", physical(frame))]


def test_rollup_reads_only_what_it_sums(stored):
    pairs = R.membership(stored("files_now"))
    assert read_columns(pairs) == [{"batch", "sample", "size", "created", "modified", "fingerprint"}]
    plan = physical(pairs)
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and plan.count("Exchange") == 1
    # The second level regroups the first; nothing is read or shuffled by file again.
    assert physical(R.batch_rollup(pairs)).count("FileScan") == 1


def test_rules_are_one_scan_with_a_pushed_filter(stored):
    plan = physical(W.candidates(stored("samples"), rules.normalise_rules(V.RULES)))
    assert plan.count("FileScan") == 1 and "EqualTo(status,indexed)" in plan and "Exchange" not in plan


@pytest.mark.parametrize("capacity", [{"SJF": 2, "LJF": 14}, {"SJF": 5000, "LJF": 14}])
def test_queues_are_ranked_in_parts_first(stored, capacity):
    plan = physical(W.first_per_queue(stored("tasks"), capacity))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    # The plan is printed from its end: by queue last, by queue and part before.
    assert len(keys) == 2 and "_part" not in keys[0] and "_part" in keys[1]


def test_queues_are_limited_on_both_sides_of_the_shuffle(stored):
    plan = physical(W.first_per_queue(stored("tasks"), {"SJF": 2, "LJF": 14}))
    assert re.findall(r"WindowGroupLimit .*?, 14, (Partial|Final)", plan) == ["Final", "Partial"] * 2


def test_passes_open_only_the_buckets_of_their_changes(spark, tmp_path):
    root = str(tmp_path)
    schema = spark.createDataFrame([("a", 1)], "k string, v int").schema
    rows = spark.range(2000).selectExpr("concat('k', id) AS k", "int(id) AS v")
    tables.append_rows(rows, root, "t", 0, tables.bucket("k"))
    wanted = spark.createDataFrame([("k1",), ("k2",)], "k string")
    at = tables.buckets_of(wanted, at=tables.bucket("k"))["at"]
    assert 1 <= len(at) <= 2 < len(os.listdir(tmp_path / "t")) // 2
    frame = tables.read_live(spark, root, "t", schema, "k", 0, wanted, buckets=at)
    plan = physical(frame)
    named = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    listed = ",".join(map(str, at))
    assert "in_bucket#" in named and (f"IN ({listed})" in named or f"= {listed})" in named) and "as_of" in named
    assert {re.search("in_bucket=([0-9]+)", f).group(1) for f in frame.inputFiles()} == {str(b) for b in at}
    assert {r["k"]: r["v"] for r in frame.collect()} == {"k1": 1, "k2": 2}


def exchanges_below(frame, node):
    """The lines of the plan below the first such node, to the next exchange."""
    lines = physical(frame).splitlines()
    start = next(i for i, line in enumerate(lines) if node in line)
    below = []
    for line in lines[start + 1:]:
        below.append(line)
        if "Exchange" in line:
            break
    return below


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_not_grouped_where_they_were_joined(spark, sf_dir, no_broadcast, stored):
    """A join in place of a grouping could not be split: another exchange or a smaller side lies between."""
    files = stored("files_now")
    diff = D.snapshot_diff(files, files.filter("size % 2 = 0"))
    totals = physical(R.affected_totals(files, diff, "sample"))
    assert totals.index("Join") < totals.index("HashAggregate") and totals.count("LeftSemi") == 1
    pages = R.member_map(files, "batch", 10)
    assert any("REPARTITION_BY_COL" in line for line in exchanges_below(pages, "Aggregate"))


def test_only_renamed_rows_look_for_their_origin(spark, sf_dir, no_broadcast):
    found = E.event_diff(V.renaming_events(spark, sf_dir), V.catalog(spark, sf_dir), V.LINK_DIR)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Join LeftOuter, (from_link", 1)[1]
    assert "isnotnull(from_link" in below and "Join LeftOuter, (from_link" not in below


def test_diff_reads_each_side_once(spark, sf_dir):
    both = D.key_sides(V.files_now(spark, sf_dir), V.catalog_active(spark, sf_dir))
    assert physical(both).count("FileScan") <= 4 and physical(both).count("FullOuter") == 1


def test_hierarchy_expands_pairs_and_not_files(stored):
    plan = physical(R.hierarchy(R.membership(stored("files_now"))))
    assert plan.count("Exchange") == 2 and plan.index("Expand") < plan.rindex("HashAggregate")


def test_newest_versions_are_folded_before_the_shuffle(stored):
    plan = physical(versions.live(stored("files_now").select("symlink", "size", "modified"), "symlink", "modified"))
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan


def test_a_pass_reads_the_stored_files_once_and_narrow(spark, tmp_path, monkeypatch):
    """What a pass writes of files follows from the difference: no fold of whole file rows, and fingerprints stay out of it."""
    from stowage import views as V
    from stowage.plans import indexing
    from pyspark.sql import functions as F

    folds, read = [], indexing.tables.read_live

    def seen(spark, root, table, schema, key, upto=None, only=None, columns=None, *rest, **more):
        if table == "files":
            folds.append(columns)
        return read(spark, root, table, schema, key, upto, only, columns, *rest, **more)

    monkeypatch.setattr(indexing.tables, "read_live", seen)
    listing = V.inventory(spark, "/root/testdata/sf0.001")
    for now, rows in (("2001-01-01", listing), ("2001-01-02", listing.withColumn("size", F.col("size") + (F.col("ino") % 5 == 0).cast("long")))):
        indexing.sync_listing(spark, str(tmp_path), rows, V.LINK_DIR, V.ts(now))
    assert folds and all(columns and "fingerprint" not in columns for columns in folds)
    found = indexing.read_files(spark, str(tmp_path)).filter("ino % 5 = 0")
    old, new = found.filter("born = 0"), found.filter("born = 1")
    pairs = old.alias("o").join(new.alias("n"), "symlink").filter(
        "o.status = 'deprecated' and n.status = 'indexed' and o.next_version = n.fingerprint and n.previous_version = o.fingerprint and o.size + 1 = n.size")
    assert pairs.count() == old.count() == new.count() > 0


def test_cycles_do_not_go_through_the_listing_again(spark, sf_dir, monkeypatch):
    """What three cycles take of the listing is there before the first one."""
    from stowage import queries

    cycles = []
    monkeypatch.setattr(queries.scheduling, "run_stored_cycle", lambda *_, **given: cycles.append(given))
    queries.QUERIES["completed_cycle"](spark, sf_dir)
    tasks = spark.createDataFrame([("t", "S1", "polish_v0-3-1")], "task_id string, sample_id string, pipeline_id string")
    assert len(cycles) == 3
    for given in cycles:
        shaped = given["shapers"].get("polish_v0-3-1")[0](tasks)
        assert not [f for f in shaped.inputFiles() + given["results"].inputFiles() if "orders.parquet" in f]


def test_only_jobs_of_running_tasks_are_grouped(spark, sf_dir):
    from stowage.operators import jobs as J

    listed = spark.range(10).selectExpr("id AS job_id", "current_timestamp() AS start", "current_timestamp() AS limit", "'RUNNING' AS status")
    out = J.reconcile(V.tasks(spark, sf_dir), listed, V.exit_codes(spark, sf_dir), V.ts(V.NOW))
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = next(k for k, line in enumerate(lines) if "Aggregate" in line and "AS _j#" in line)
    assert "Join LeftSemi" in lines[grouped + 1] + lines[grouped + 2]


def test_a_wide_pass_folds_no_pairs(spark, tmp_path, monkeypatch):
    """Tables with one pass in each bucket are read as they stand, and a pass that changes much has all pairs once and folds them no more."""
    from stowage.plans import indexing

    folds, fold = [], tables.live

    def seen(rows, key, *order):
        folds.append(key)
        return fold(rows, key, *order)

    monkeypatch.setattr(tables, "live", seen)
    listing, root = V.inventory(spark, "/root/testdata/sf0.001"), str(tmp_path)
    indexing.sync_listing(spark, root, listing, V.LINK_DIR, V.ts("2001-01-01"))
    assert not folds
    larger = listing.filter("ino % 7 != 0").withColumn("size", F.col("size") + (F.col("ino") % 2 == 0).cast("long"))
    indexing.sync_listing(spark, root, larger, V.LINK_DIR, V.ts("2001-01-02"))
    assert indexing.PAIR not in folds
    files = D.as_files(larger, V.LINK_DIR)
    pairs = indexing.read_membership(spark, root)
    assert sorted(pairs.collect()) == sorted(R.membership(files).select(*pairs.columns).collect())
    batches = indexing.current_batches(spark, root)
    expected = R.dated_sample_rollup(pairs, batches)
    now = indexing.current_samples(spark, root).select(*expected.columns)
    assert sorted(now.collect()) == sorted(expected.collect()) and now.count() > 0


def test_only_pairs_that_keep_files_are_read_again(spark, sf_dir):
    files = D.as_files(V.inventory(spark, sf_dir), V.LINK_DIR)
    after = files.withColumn("size", F.col("size") + 1)
    after = after.withColumn("fingerprint", F.sha2(F.col("size").cast("string"), 256))
    changed = D.changed_files(D.snapshot_diff(after, files))
    asked = []

    def again(stale):
        asked.append(stale.count())
        return after.join(stale, R.PAIR, "left_semi")

    found = R.apply_deltas(R.membership(files), changed, again)
    expected = R.membership(after).select(*found.columns)
    assert sorted(found.collect()) == sorted(expected.collect()) and asked == [0]


def test_buckets_are_found_without_sets(spark):
    rows = spark.range(1000).selectExpr("string(id) AS k", "CASE WHEN id < 3 THEN string(id) END AS few", "string(null) AS none")
    found = tables.buckets_of(rows, k=tables.bucket("k"), few=F.when(F.col("few").isNotNull(), tables.bucket("few")),
                              none=F.when(F.col("none").isNotNull(), tables.bucket("none")))
    assert found["k"] == list(range(tables.BUCKETS)) and found["none"] == []
    assert found["few"] == sorted({r[0] for r in rows.filter("few is not null").select(tables.bucket("few")).collect()})
    assert tables.buckets_of(rows.filter("k = ''"), k=tables.bucket("k"))["k"] == []
