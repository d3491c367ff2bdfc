"""Readers and the stored catalog."""

import json
import os
import threading

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stowage import session, views as V
from stowage.functions.predicates import active
from stowage.operators import diff as D, rollup as R
from stowage.operators.shapers import INPUT_CONTRACT, ContractError, Shapers, check_contract, row_shaper
from stowage.plans import indexing as I
from stowage.sources import jobs, listing, rules, tables


@pytest.fixture
def tree(tmp_path):
    for name in ("S1/1_2_3_B1/raw/a.pod5", "S1/1_2_3_B1/raw/b.fastq.gz", "S1/1_2_3_B1/skip/c.pod5",
                 "S2/1_2_3_B2/raw/d.txt", "S2/1_2_3_B2/final_summary_B2.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * len(name))
    return tmp_path


def test_listing(spark, tree):
    found = listing.scan_listing(spark, [str(tree)], ["pod5", "fastq.gz"], exclude_dirs=["skip"])
    assert sorted(r["filepath"] for r in found.collect()) == [
        f"{tree}/S1/1_2_3_B1/raw/a.pod5", f"{tree}/S1/1_2_3_B1/raw/b.fastq.gz"]
    assert {r["size"] for r in found.collect()} == {22, 26}
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_listing_keeps_any_name_and_goes_on_past_what_it_cannot_read(spark, tree, monkeypatch):
    for name in ("_a.pod5", ".b.pod5", "c d[1].pod5"):
        (tree / name).write_bytes(b"1")
    (tree / "gone.pod5").symlink_to(tree / "nowhere")
    names = {r["filepath"].rsplit("/", 1)[1] for r in listing.scan_listing(spark, [str(tree)], ["pod5"]).collect()}
    assert names == {"_a.pod5", ".b.pod5", "c d[1].pod5", "a.pod5", "c.pod5"}
    lost = {r["filepath"]: r["error"] for r in listing.unreadable(spark, [str(tree), f"{tree}/absent"]).collect()}
    assert set(lost) == {f"{tree}/gone.pod5", f"{tree}/absent"}


def test_listing_takes_names_of_any_bytes(spark, tmp_path):
    folder = os.fsencode(tmp_path / "tree")
    os.makedirs(folder + b"/d\xe9")
    for name in (b"a\xff.pod5", b"d\xe9/b.pod5", "ü%41.pod5".encode()):
        with open(folder + b"/" + name, "wb") as f:
            f.write(b"xyz")
    found = {r["filepath"][len(os.fsdecode(folder)) + 1:]: r["size"] for r in listing.scan_listing(spark, [str(tmp_path / "tree")], ["pod5"]).collect()}
    assert found == {"a%FF.pod5": 3, "d%E9/b.pod5": 3, "ü%41.pod5": 3}
    raw = {bytes(r["raw"]) for r in listing.walk(spark, [str(tmp_path / "tree")]).collect()}
    assert raw == {folder + n for n in (b"/a\xff.pod5", b"/d\xe9", b"/d\xe9/b.pod5", "/ü%41.pod5".encode())}


def test_excluded_folders_are_not_opened_and_the_root_may_lie_in_one(spark, tmp_path):
    root = tmp_path / "skip" / "root"
    for name in ("a.pod5", "skip/b.pod5", "deep/skip/c.pod5", "deep/d.pod5"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"1")
    (root / "skip").chmod(0)
    try:
        found = {r["filepath"][len(str(root)) + 1:] for r in listing.scan_listing(spark, [str(root)], ["pod5"], ["skip"]).collect()}
        walked = {r["filepath"][len(str(root)) + 1:] for r in listing.walk(spark, [str(root)], ["skip"]).collect()}
    finally:
        (root / "skip").chmod(0o755)
    assert found == {"a.pod5", "deep/d.pod5"} and walked == {"a.pod5", "deep", "deep/d.pod5"}


def test_large_folders_come_in_parts(tmp_path):
    for k in range(2500):
        (tmp_path / f"{k}.pod5").touch()
    batch = pa.RecordBatch.from_arrays([pa.array([os.fsencode(tmp_path)], pa.binary())], names=["raw"])
    parts = [b.num_rows for b in listing._visit(frozenset(), 1000)([batch])]
    assert parts == [1000, 1000, 500]


def test_damaged_input_is_set_aside(spark, tmp_path):
    for name, text in (("a.json", '{"jobs": [{"job_id": 1, "job_state": ["RUNNING"]}]}'), ("b.json", '{"jobs": [{"job_id": 2'),
                       ("c.json", '{"jobs": [{"job_id": "x"}]}'), ("d.json", "{}"), ("e.json", "")):
        (tmp_path / name).write_text(text)
    assert [r["job_id"] for r in jobs.read_jobs(spark, str(tmp_path)).collect()] == [1]
    lost = {r["filepath"].rsplit("/", 1)[1]: r["text"] for r in jobs.damaged_jobs(spark, str(tmp_path)).collect()}
    assert lost == {"b.json": '{"jobs": [{"job_id": 2', "c.json": '{"jobs": [{"job_id": "x"}]}'}


def test_shared_folder(spark):
    assert session._folder("hdfs:///x", "yarn") == "hdfs:///x"
    assert session._folder(None, "local[4]") == session._folder(None, "local")
    with pytest.raises(session.NoSharedFolder, match="spark.checkpoint.dir"):
        session._folder(None, "spark://host:7077")


def test_intermediates_go_when_their_pass_ends(spark, tmp_path):
    with session.intermediates(spark):
        kept = session.written(spark.range(3).toDF("i"), "gone").inputFiles()
    assert kept and not any(os.path.exists(f.removeprefix("file://")) for f in kept)


def test_passes_at_once_and_in_each_other_keep_their_own(spark):
    def alive(frame):
        return all(os.path.exists(f.removeprefix("file://")) for f in frame.inputFiles())

    first, second, seen = threading.Event(), threading.Event(), {}

    def one():
        with session.intermediates(spark):
            seen["one"] = session.written(spark.range(3).toDF("i"), "one")
            first.set()
            second.wait(60)
        seen["other"] = alive(seen["two"])

    def two():
        first.wait(60)
        with session.intermediates(spark):
            seen["two"] = session.written(spark.range(4).toDF("i"), "two")
            second.set()
            threads[0].join(60)
            seen["count"] = seen["two"].count()

    threads = [threading.Thread(target=f) for f in (one, two)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert seen["other"] and seen["count"] == 4 and not alive(seen["one"]) and not alive(seen["two"])
    with session.intermediates(spark):
        outer = session.written(spark.range(2).toDF("i"), "outer")
        with session.intermediates(spark):
            inner = session.written(spark.range(2).toDF("i"), "inner")
        assert alive(outer) and not alive(inner)
        later = session.written(spark.range(2).toDF("i"), "later")
    assert not alive(outer) and not alive(later)


def test_reports_are_kept_and_looked_up(spark, tmp_path):
    root = str(tmp_path)
    at = V.ts(V.NOW)

    def listed(size):
        return spark.createDataFrame([(f"/s/S/1_2_3_{b}/raw/{b}.pod5", s) for b, s in (("B1", size), ("B2", 5))], "filepath string, size long").selectExpr(
            "filepath", "size", "timestamp'2024-01-01' AS ctime", "timestamp'2024-01-01' AS mtime", "1L AS dev", "1L AS ino", "1L AS nlink")

    def reports(*names):
        return spark.createDataFrame([(f"/r/final_summary_{n}.txt", "final_summary") for n in names], "filepath string, report_type string")

    def state():
        return {r["batch"]: r["final_summary"] for r in I.current_batches(spark, root).collect()}

    I.sync_listing(spark, root, listed(1), "/links", at, reports=reports("B1"))
    assert state() == {"B1": "/r/final_summary_B1.txt", "B2": None}
    I.sync_listing(spark, root, listed(2), "/links", at)
    assert state() == {"B1": "/r/final_summary_B1.txt", "B2": None}
    # A report that comes later reaches a batch whose files did not change.
    I.sync_listing(spark, root, listed(3), "/links", at, reports=reports("B2"))
    assert state() == {"B1": "/r/final_summary_B1.txt", "B2": "/r/final_summary_B2.txt"}
    old = I.read_batches(spark, root).filter("batch = 'B1' and status = 'deprecated'")
    assert old.count() == 2 and I.read_batches(spark, root).filter("batch = 'B2'").count() == 1


def test_empty_listing(spark, tree):
    with pytest.raises(listing.EmptyListing):
        listing.scan_listing(spark, [str(tree)], ["bam"])
    assert listing.scan_listing(spark, [str(tree)], ["bam"], empty_ok=True).count() == 0


def test_several_roots(spark, tree):
    found = listing.scan_listing(spark, [f"{tree}/S1", f"{tree}/S2"], ["pod5", "txt"])
    assert found.count() == 4


def test_reports(spark, tree):
    rows = listing.scan_reports(spark, [str(tree)]).collect()
    assert [(r["filepath"].rsplit("/", 1)[1], r["report_type"]) for r in rows] == [("final_summary_B2.txt", "final_summary")]


def test_inventory_csv(spark, tmp_path):
    (tmp_path / "i.csv").write_text("/a/S/1_2_3_B/r/x.pod5,5,2024-01-01 00:00:00,2024-01-02 00:00:00,1,2,1,true,false,false,2024-01-03 00:00:00\n")
    row = listing.read_inventory(spark, str(tmp_path / "i.csv"), "csv").first()
    assert row["size"] == 5 and row["is_file"] and row["mtime"].day == 2


def test_job_snapshot(spark, tmp_path):
    document = {"jobs": [
        {"job_id": 7, "name": "head", "array_job_id": {"number": 0}, "nodes": "n1,n2", "partition": "gpu",
         "priority": {"number": 3}, "job_state": ["PENDING", "RUNNING"], "standard_error": "/dev/null",
         "standard_output": "/o", "exit_code": {"number": 0}, "current_working_directory": "/w",
         "start_time": {"number": 60}, "end_time": {"number": 0}, "unknown_field": 1},
        {"job_id": 8, "comment": "parent_job_id 7", "job_state": ["PENDING"], "start_time": {"number": 60}},
        {"name": "no id"}, {"job_id": 0}]}
    (tmp_path / "jobs.json").write_text(json.dumps(document, indent=1))
    rows = {r["job_id"]: r for r in jobs.read_jobs(spark, str(tmp_path)).collect()}
    assert set(rows) == {7, 8}
    assert rows[7]["status"] == "RUNNING" and rows[7]["nodes"] == ["n1", "n2"] and rows[7]["stderr"] == ""
    assert rows[7]["start"] is not None and rows[7]["limit"] is None
    assert rows[8]["parent_job_id"] == 7 and rows[8]["start"] is None and rows[8]["priority"] == 0


def test_accounting(spark, tmp_path):
    (tmp_path / "acct.txt").write_text(
        "       JobID      State ExitCode\n------------ ---------- --------\n         12  COMPLETED      0:0\n         13    RUNNING\n")
    found = jobs.read_accounting(spark, str(tmp_path))
    assert found.count() == 2
    assert tuple(jobs.job_record(found, "12").first()) == ("12", "COMPLETED", "0:0")
    assert jobs.job_record(found, "13").first()["exit_code"] is None


def test_exit_codes(spark, tmp_path):
    (tmp_path / "a.exitcode").write_text("124\nrest 5\n")
    (tmp_path / "b.exitcode").write_text("oops\n0\n")
    rows = {r["filepath"].rsplit("/", 1)[1]: r["exit_code"] for r in jobs.read_exit_codes(spark, f"{tmp_path}/*.exitcode").collect()}
    assert rows == {"a.exitcode": 124, "b.exitcode": None}


def test_rule_defaults(spark):
    row = rules.load_rules(spark, {"x_v1": {}}).first()
    assert (row["pipeline_id"], row["timeout"], row["conditions"], row["sorting"]) == ("x_v1", "00:00", [], "")
    assert rules.load_rules(spark, V.RULES).count() == 3


def test_passes_fold_to_the_newest(spark, tmp_path):
    root = str(tmp_path)
    schema = spark.createDataFrame([("a", 1)], "k string, v int").schema
    place = tables.bucket("k")

    def append(version, *rows):
        tables.append_rows(spark.createDataFrame(rows, schema), root, "t", version, place)

    assert tables.latest_version(spark, root, "passes") == -1
    assert tables.read_live(spark, root, "t", schema, "k").count() == 0
    append(0, ("a", 1), ("b", 1))
    append(1, ("a", 2))
    append(2, ("c", 3))

    def state(**options):
        return {r["k"]: r["v"] for r in tables.read_live(spark, root, "t", schema, "k", **options).collect()}

    assert state() == {"a": 2, "b": 1, "c": 3}
    assert state(upto=0) == {"a": 1, "b": 1}
    some = spark.createDataFrame([("a",)], "k string")
    at = tables.buckets_of(some, at=place)["at"]
    assert state(only=some) == state(only=some, buckets=at) == {"a": 2}
    assert state(buckets=[]) == {}
    # A pass written again replaces itself.
    append(1, ("a", 4))
    assert state() == {"a": 4, "b": 1, "c": 3}
    assert tables.compact(spark, root, "t", schema, "k", 2, place=place) == at
    assert state() == {"a": 4, "b": 1, "c": 3} and len(os.listdir(tmp_path / "t" / f"in_bucket={at[0]}")) == 1
    append(3, ("b", 9))
    assert state() == {"a": 4, "b": 9, "c": 3}


def test_compaction_deals_rows_once(spark, tmp_path, monkeypatch):
    root, schema, place, plans = str(tmp_path), "k string, v int", tables.bucket("k"), []
    schema = spark.createDataFrame([], schema).schema
    for version in (0, 1, 2):
        rows = spark.range(300).selectExpr("cast(id as string) AS k", f"cast(id + {version} as int) AS v").filter(f"v % {version + 1} = 0")
        tables.append_rows(rows, root, "t", version, place)
    before = {r["k"]: r["v"] for r in tables.read_live(spark, root, "t", schema, "k").collect()}
    append = tables.append_rows

    def seen(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        append(df, *rest)

    monkeypatch.setattr(tables, "append_rows", seen)
    assert len(tables.compact(spark, root, "t", schema, "k", 2, place=place)) == tables.BUCKETS
    assert len(plans) == 1 and plans[0].count("Exchange") == 1 and "max_by" in plans[0]
    rows = tables.read_rows(spark, root, "t", schema).collect()
    assert {r["k"]: r["v"] for r in rows} == before and len(rows) == len(before) == 300 and {r["as_of"] for r in rows} == {2}
    placed = spark.read.parquet(f"{root}/t")
    assert placed.filter(placed["in_bucket"] != place).count() == 0


def test_unfinished_passes_do_not_count(spark, tmp_path):
    root = str(tmp_path)
    for version in (0, 1, 10):
        tables.finish(spark.range(version).toDF("n"), root, "passes", version)
    (tmp_path / "passes" / "as_of=11").mkdir()
    assert tables.latest_version(spark, root, "passes") == 10
    assert tables.read_finished(spark, root, "passes", spark.range(1).toDF("n").schema, 0).count() == 0


def test_a_repeated_pass_changes_nothing(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    before = V.previous_inventory(spark, sf_dir).filter("state is null or state = 'indexed'")
    I.sync_listing(spark, root, before, V.LINK_DIR, V.ts(V.CATALOG_TIME))
    now = V.inventory(spark, sf_dir)
    I.sync_listing(spark, root, now, V.LINK_DIR, V.ts(V.NOW))

    def state():
        return sorted((tuple(r) for r in I.current_batches(spark, root).collect()), key=repr)

    first = state()
    I.sync_listing(spark, root, now, V.LINK_DIR, V.ts(V.NOW), version=1)
    assert state() == first
    assert I.sync_listing(spark, root, now, V.LINK_DIR, V.ts(V.NOW)) == 2
    assert state() == first
    assert tuple(I.read_pass(spark, root, 2).first()) == (0, 0, 0)
    I.compact(spark, root)
    assert state() == first
    files = I.current_files(spark, root)
    assert files.count() == now.count()
    assert R.repeated_keys(files, ["dev", "ino"]).count() == 0
    # Version links meet: every deprecated row names the fingerprint that replaced it.
    every = I.read_files(spark, root)
    old = every.filter("status = 'deprecated'").select("symlink", F.col("next_version").alias("fingerprint"))
    assert old.count() > 0 and old.join(every.filter(active()), ["symlink", "fingerprint"], "left_anti").count() == 0


def test_everything_deleted(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    now = V.inventory(spark, sf_dir)
    I.sync_listing(spark, root, now, V.LINK_DIR, V.ts(V.CATALOG_TIME))
    I.sync_listing(spark, root, now.limit(0), V.LINK_DIR, V.ts(V.NOW))
    assert I.current_files(spark, root).count() == 0
    assert I.current_batches(spark, root).count() == 0 and I.current_samples(spark, root).count() == 0
    assert I.read_membership(spark, root).count() == 0
    assert {r["status"] for r in I.read_files(spark, root).select("status").distinct().collect()} == {"deleted"}


def test_shaper_registry(spark):
    registry = Shapers()
    with pytest.raises(TypeError):
        registry.register("p", "not a function", lambda t: t)
    with pytest.raises(KeyError):
        registry.get("p")
    registry.register("p", lambda t: t, lambda t: t)
    assert "p" in registry and len(registry.get("p")) == 2


def test_shaper_contract(spark):
    frame = spark.createDataFrame([("t", 1)], "task_id string, n_groups long")
    with pytest.raises(ContractError):
        check_contract(frame, INPUT_CONTRACT, "p")
    with pytest.raises(ContractError):
        check_contract("text", {}, "p")
    upper = row_shaper(lambda f: f.assign(task_id=f["task_id"].str.upper()), "task_id string, n_groups long")
    assert upper(frame).first()["task_id"] == "T"


def test_union_of_listings(spark, tree):
    one = listing.scan_listing(spark, [f"{tree}/S1"], ["pod5"])
    twice = D.union_roots(one, one)
    assert D.one_per_path(twice).count() == one.count() == twice.count() // 2


def test_small_files_are_written_by_as_many_tasks_as_they_need(spark, sf_dir, monkeypatch):
    """Exit-code files are dealt by number, since their bytes would make one task of them; job documents are compressed."""
    import os
    from stowage import queries

    monkeypatch.setattr(queries, "FILES_A_TASK", 4)
    root = queries._exit_code_files(spark, sf_dir)
    names = [n for _, _, files in os.walk(root.removeprefix("file:")) for n in files if n.startswith("part-")]
    suppliers = queries.V.table(spark, sf_dir, "supplier").count()
    assert len(names) == suppliers and len({n.split("-")[1] for n in names}) > suppliers // 16
    root = queries._job_documents(spark, sf_dir)
    assert {n.endswith(".txt.gz") for _, _, files in os.walk(root.removeprefix("file:")) for n in files if n.startswith("part-")} == {True}
