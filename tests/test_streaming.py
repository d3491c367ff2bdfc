"""Streams against their batch counterparts."""

import random
import time
from datetime import datetime, timedelta

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from stowage import views as V
from stowage.operators import events as E, ordered
from stowage.plans import indexing as I
from stowage.schemas import FILE_EVENTS
from stowage.streaming import events as S, state as T

START = datetime(2024, 1, 1)


def test_debounce_stream_equals_batch(spark, sf_dir, tmp_path):
    rows = V.file_events(spark, sf_dir).select("event_id", "src_path", "ts")
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows.write.parquet(source)
    stream = S.debounce(S.read_events(spark, source, schema=rows.schema), ["src_path"], gap="3 hours",
                        payload=["event_id"], tie=["event_id"])
    S.start(stream, target, checkpoint).awaitTermination()
    held = S.open_bursts(spark, checkpoint, ["src_path"], ["event_id"])
    assert held.columns == stream.columns and held.count() > 0
    streamed = {(r["src_path"], r["event_id"]) for r in spark.read.parquet(target).unionByName(held).collect()}
    batch = ordered.settled(rows, ["src_path"], "ts", 3 * 3600, tie=["event_id"])
    assert streamed == {(r["src_path"], r["event_id"]) for r in batch.collect()}


def test_writes_are_due_after_their_target_is_quiet(spark, tmp_path):
    rows = spark.createDataFrame(
        [("files", START + timedelta(seconds=n)) for n in (0, 5, 14, 30)] + [("batches", START)],
        "target string, ts timestamp")
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows.write.parquet(source)
    stream = S.due_writes(S.read_events(spark, source, schema=rows.schema))
    S.start(stream, target, checkpoint).awaitTermination()
    due = spark.read.parquet(target).unionByName(S.open_bursts(spark, checkpoint, ["target"]))
    found = {(r["target"], (r["settled_at"] - START).seconds, r["n_events"]) for r in due.collect()}
    assert found == {("files", 14, 3), ("files", 30, 1), ("batches", 0, 1)}


def test_open_bursts_go_on_after_a_restart(spark, tmp_path):
    """Reading what is open changes nothing: later events join their bursts, over any number of restarts."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = spark.createDataFrame([("a", START)], "src_path string, ts timestamp").schema

    def drop(*seconds):
        spark.createDataFrame([("a", START + timedelta(seconds=n)) for n in seconds], schema).coalesce(1).write.mode("append").parquet(source)
        stream = S.debounce(S.read_events(spark, source, schema=schema), ["src_path"], gap="10 seconds")
        S.start(stream, target, checkpoint).awaitTermination()
        return [(r["settled_at"] - START).seconds for r in S.open_bursts(spark, checkpoint, ["src_path"]).collect()]

    assert drop(0, 4) == [4] and drop(9) == [9] and drop(30) == [30] and drop(35, 39) == [39]
    settled = sorted(((r["settled_at"] - START).seconds, r["n_events"]) for r in spark.read.parquet(target).collect())
    assert settled == [(9, 3)]
    assert drop(100) == [100]
    assert spark.read.parquet(target).count() == 2


def test_transitions_within_a_micro_batch_and_across_restarts(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "root", "cp"))
    schema = "task_id string, polled_at timestamp, status string"
    many = [("t", START + timedelta(seconds=k), "a" if k < 15000 else "b") for k in range(30000)]
    random.Random(1).shuffle(many)
    later = [("t", START + timedelta(days=1), "b"), ("u", None, "x"), ("t", START + timedelta(days=2), "c")]
    for rows in (many, later):
        frame = spark.createDataFrame(rows, schema)
        frame.write.mode("append").parquet(source)
        T.track_transitions(S.read_events(spark, source, schema=frame.schema), root, checkpoint).awaitTermination()
    found = sorted((r["task_id"], r["previous_status"] or "", r["status"]) for r in T.read_transitions(spark, root).collect())
    assert found == [("t", "", "a"), ("t", "a", "b"), ("t", "b", "c"), ("u", "", "x")]


def test_modifications_wait_and_everything_else_goes_on_at_once(spark, tmp_path):
    root, source, checkpoint = (str(tmp_path / n) for n in ("cat", "in", "cp"))
    a, b, c, d = (path("S1", "B1", f"{n}.pod5") for n in "abcd")

    def drop(*rows, gap="1 hour"):
        spark.createDataFrame(list(rows), FILE_EVENTS).coalesce(1).write.mode("append").parquet(source)
        S.sync_catalog(S.quiet_events(S.read_events(spark, source), gap=gap), root, "/links", V.ts(V.NOW), checkpoint, 0).awaitTermination()
        return state()

    def state():
        return {r["filepath"]: r["size"] for r in I.current_files(spark, root).collect()}

    def waiting():
        return sorted((r["src_path"], r["size"], r["event_type"]) for r in S.open_modifications(spark, checkpoint).collect())

    assert drop(event("created", a, 1, 10), event("modified", a, 2, 20), event("created", b, 2, 5)) == {a: 10, b: 5}
    assert waiting() == [(a, 20, "modified")]
    # Later ones, in any order, take the place of those that wait; one without stat fields keeps the newest there were.
    assert drop(event("modified", a, 5), event("modified", a, 4, 25), event("modified", b, 6, 7), event("created", c, 3, 1)) == {a: 10, b: 5, c: 1}
    assert waiting() == [(a, 25, "modified"), (b, 7, "modified")]
    # A path that goes takes its content with it, and does not come back.
    assert drop(event("moved", a, 8, dest=d), event("deleted", b, 9)) == {d: 25, c: 1}
    assert waiting() == [] and state() == {d: 25, c: 1}
    assert drop(event("modified", d, 10, 30), gap="1 second") == {d: 25, c: 1}
    time.sleep(2)
    assert drop(event("modified", c, 11, 2), gap="1 second") == {d: 30, c: 1}
    I.sync_events(spark, root, S.open_modifications(spark, checkpoint), "/links", V.ts(V.NOW))
    assert state() == {d: 30, c: 2}


def test_logs_that_are_rotated_within_seconds_are_all_kept(spark, tmp_path):
    root, source, checkpoint = (str(tmp_path / n) for n in ("cat", "in", "cp"))
    log, old = path("S1", "B1", "log.pod5"), path("S1", "B1", "log-1.pod5")
    rows = [event("created", log, 0, 10, ino=1), event("moved", log, 1, dest=old), event("created", log, 2, 20, ino=2)]
    spark.createDataFrame(rows, FILE_EVENTS).write.parquet(source)
    S.sync_catalog(S.quiet_events(S.read_events(spark, source)), root, "/links", V.ts(V.NOW), checkpoint, 0).awaitTermination()
    assert {r["filepath"]: r["size"] for r in I.current_files(spark, root).collect()} == {log: 20, old: 10}


@given(st.lists(st.tuples(st.integers(0, 9), st.booleans(), st.sampled_from([None, "s", "t"])), max_size=12), st.integers(0, 12))
def test_folding_a_busy_path_loses_nothing(rows, cut):
    def due(events):
        out, last = [], None
        for at, loss, stat in events:
            if loss and last:
                out.append(last)
            last = None if loss else (at, stat if stat is not None else last and last[1])
        return out, last

    plain = due(sorted(rows, key=lambda r: r[:2]))
    assert due(S._folded(rows)) == plain
    ordered_rows = sorted(rows, key=lambda r: r[:2])
    assert due(S._folded(S._folded(ordered_rows[:cut]) + ordered_rows[cut:])) == plain


def test_create_then_rename_twice_then_create_again(spark):
    """A file's content follows it as of each move, whatever its old names hold later."""
    t1, t2, t3 = (path("S1", "B1", n) for n in ("1.pod5", "2.pod5", "3.pod5"))
    rows = [event("created", t1, 1, 10), event("moved", t1, 2, dest=t2), event("created", t1, 3, 99, ino=5),
            event("moved", t2, 4, dest=t3), event("moved", t1, 5, dest=t2)]
    empty = ("symlink string, filepath string, size long, dev long, ino long, nlink long, created timestamp, "
             "modified timestamp, batch string, sample string, status string, fingerprint string")
    found = E.event_diff(spark.createDataFrame(rows, FILE_EVENTS), spark.createDataFrame([], empty), "/links").collect()
    assert {r["new_filepath"]: (r["change_type"], r["new_size"]) for r in found} == {
        t3: ("added", 10), t2: ("added", 99)}


def test_only_links_that_are_there_look_for_their_content(spark):
    """A name that a file only passed through asks for nothing; the last one asks the stored link at the beginning."""
    t1, t2, t3 = (path("S1", "B1", n) for n in ("1.pod5", "2.pod5", "3.pod5"))
    rows = [event("moved", t1, 1, dest=t2), event("moved", t2, 2, dest=t3)]
    seen = {r["filepath"] or r["symlink"]: (r["present"], r["from_link"]) for r in E.observations(
        spark.createDataFrame(rows, FILE_EVENTS), "/links").collect()}
    first, second = ("/links/pod5/B1:S1:1.pod5", "/links/pod5/B1:S1:2.pod5")
    assert seen == {first: (False, None), second: (False, None), t3: (True, first)}


def test_content_after_a_move_is_not_that_of_the_move(spark):
    """A stored file is renamed and its old name written anew: the new name has the stored content, then what a later move brings."""
    t1, t2, t3 = (path("S1", "B1", n) for n in ("1.pod5", "2.pod5", "3.pod5"))
    rows = [event("moved", t1, 1, dest=t2), event("created", t1, 2, 7, ino=9), event("moved", t1, 3, dest=t3), event("created", t1, 4, 8, ino=10)]
    seen = {r["filepath"]: (r["from_link"], r["size"]) for r in E.observations(spark.createDataFrame(rows, FILE_EVENTS), "/links").collect()}
    assert seen == {t1: (None, 8), t2: ("/links/pod5/B1:S1:1.pod5", None), t3: (None, 7)}


def test_shallow_paths_are_rejected_by_event_passes(spark, tmp_path):
    root, good = str(tmp_path), path("S1", "B1", "a.pod5")
    rows = [event("created", "/x/y.pod5", 1, 1), event("created", good, 1, 2), event("moved", good, 2, dest="/x/z.pod5")]
    I.sync_events(spark, root, spark.createDataFrame(rows, FILE_EVENTS), "/links", F.current_timestamp())
    assert sorted((r["symlink"], r["reason"]) for r in I.read_rejects(spark, root).collect()) == [
        ("/x/y.pod5", "path names no sample"), ("/x/z.pod5", "path names no sample")]
    assert I.current_files(spark, root).count() == 0


def event(kind, path, minute, size=None, dest=None, ino=1):
    stat = (size, START, START + timedelta(minutes=minute), 1, ino, 1) if size is not None else (None,) * 6
    return (kind, path, dest, START + timedelta(minutes=minute), *stat, False)


def path(sample, batch, name, folder="raw"):
    return f"/src/{sample}/1_2_3_{batch}/{folder}/{name}"


def test_events_reach_the_catalog_and_restarts_skip_finished_passes(spark, tmp_path):
    root, source, checkpoint = (str(tmp_path / n) for n in ("cat", "in", "cp"))
    a, b, c = path("S1", "B1", "a.pod5"), path("S1", "B1", "b.pod5"), path("S2", "B2", "c.pod5")

    def drop(*rows):
        spark.createDataFrame(list(rows), FILE_EVENTS).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = S.read_events(spark, source, maxFilesPerTrigger=1)
        S.sync_catalog(stream, root, "/links", V.ts(V.NOW), checkpoint, 0).awaitTermination()

    def files():
        return {r["filepath"]: (r["size"], r["batch"]) for r in I.current_files(spark, root).collect()}

    drop(event("created", a, 1, 10), event("modified", b, 2, 20, ino=2), event("modified", b, 3, 25, ino=2),
         event("created", c, 3, 5, ino=3), event("deleted", path("S9", "B9", "x.pod5"), 4))
    run()
    assert files() == {a: (10, "B1"), b: (25, "B1"), c: (5, "B2")}
    rejects = I.read_rejects(spark, root, 0)
    assert [r["symlink"] for r in rejects.collect()] == ["/links/pod5/B9:S9:x.pod5"]

    # A move inside the batch, a move into another one (content carried on), a deletion.
    kept, renamed = path("S1", "B1", "a.pod5", "kept"), path("S1", "B2", "b.pod5")
    drop(event("moved", a, 5, dest=kept), event("moved", b, 6, dest=renamed), event("deleted", c, 7))
    run()
    assert files() == {kept: (10, "B1"), renamed: (25, "B2")}
    batches = {r["batch"]: r for r in I.current_batches(spark, root).collect()}
    assert {k: (r["n_files"], r["size"]) for k, r in batches.items()} == {"B1": (1, 10), "B2": (1, 25)}
    assert batches["B1"]["previous_version"] != "" and I.committed(spark, root) == 1
    samples = {r["sample"]: r["size"] for r in I.current_samples(spark, root).collect()}
    assert samples == {"S1": 35}

    run()                                   # nothing new: no further pass
    assert I.committed(spark, root) == 1
    # A fresh checkpoint replays both micro-batches; their passes are finished and skipped.
    stream = S.read_events(spark, source, maxFilesPerTrigger=1)
    S.sync_catalog(stream, root, "/links", V.ts(V.NOW), str(tmp_path / "cp2"), 0).awaitTermination()
    assert I.committed(spark, root) == 1 and files() == {kept: (10, "B1"), renamed: (25, "B2")}


def test_known_link_at_another_place_with_other_content(spark):
    old = path("S1", "B1", "a.pod5")
    columns = ("symlink string, filepath string, size long, dev long, ino long, nlink long, created timestamp, "
               "modified timestamp, batch string, sample string, status string, fingerprint string")
    catalog = spark.createDataFrame(
        [("/links/pod5/B1:S1:a.pod5", old, 10, 1, 1, 1, START, START, "B1", "S1", "indexed", "f")], columns)
    events = spark.createDataFrame([event("created", path("S1", "B1", "a.pod5", "new"), 1, 11)], FILE_EVENTS)
    row = E.event_diff(events, catalog, "/links").first()
    assert row["change_type"] == "moved_modified" and row["old_filepath"] == old and row["new_size"] == 11


def test_folders_and_other_files_are_ignored(spark):
    rows = [event("created", "/a/b.pod5", 1, 1), event("created", "/a/b.tmp", 1, 1), event("created", "/A/C.POD5", 1, 1)]
    rows.append((*event("created", "/a/d.pod5", 1, 1)[:-1], True))
    found = E.watched(spark.createDataFrame(rows, FILE_EVENTS), ["*.pod5"])
    assert sorted(r["src_path"] for r in found.collect()) == ["/A/C.POD5", "/a/b.pod5"]


def test_report_set(spark):
    rows = [event("created", "/r/1.txt", 1), event("moved", "/r/1.txt", 2, dest="/r/2.txt"),
            event("created", "/r/3.txt", 3), event("deleted", "/r/3.txt", 4), event("modified", "/r/4.txt", 5)]
    found = E.report_set(spark.createDataFrame(rows, FILE_EVENTS))
    assert sorted(r["filepath"] for r in found.collect()) == ["/r/2.txt", "/r/4.txt"]


@pytest.mark.parametrize("interval", ["30 seconds"])
def test_interval_trigger_starts_and_stops(spark, tmp_path, interval):
    rows = spark.createDataFrame([event("created", "/a/b.pod5", 1, 1)], FILE_EVENTS)
    rows.write.parquet(str(tmp_path / "in"))
    query = S.start(S.read_events(spark, str(tmp_path / "in")).select(F.col("src_path")), str(tmp_path / "out"),
                    str(tmp_path / "cp"), once=False, interval=interval)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_waiting_paths_share_calls_and_a_batch_is_worked_out_once(spark, tmp_path, monkeypatch):
    """Python is called for parts of the paths, and the state of a micro-batch's parts is worked out once."""
    root, source, checkpoint = (str(tmp_path / n) for n in ("cat", "in", "cp"))
    monkeypatch.setattr(S, "PARTS", 3)
    calls, made = spark.sparkContext.accumulator(0), S._waiting

    def counted(milliseconds):
        step = made(milliseconds)

        def count(*given):
            calls.add(1)
            yield from step(*given)

        return count

    monkeypatch.setattr(S, "_waiting", counted)
    paths = [path("S1", "B1", f"{n}.pod5") for n in range(40)]
    spark.createDataFrame([event("modified", p, 1, n) for n, p in enumerate(paths)], FILE_EVENTS).write.parquet(source)
    S.sync_catalog(S.quiet_events(S.read_events(spark, source), gap="1 hour"), root, "/links", V.ts(V.NOW), checkpoint, 0).awaitTermination()
    assert calls.value == 3
    waiting = {r["src_path"]: r["size"] for r in S.open_modifications(spark, checkpoint).collect()}
    assert waiting == {p: n for n, p in enumerate(paths)}


def test_waiting_paths_are_kept_on_disk(spark, tmp_path, monkeypatch):
    """The state lies in RocksDB, the session keeps its settings, and a stream that was begun with its state in the heap goes on."""
    names = [*S._ON_DISK]
    before = [spark.conf.get(name, None) for name in names]
    monkeypatch.setattr(S, "sync_events", lambda *_: None)  # a micro-batch is worked out, the catalog is left alone

    def drop(name, *rows):
        root, source, checkpoint = (str(tmp_path / name / n) for n in ("cat", "in", "cp"))
        spark.createDataFrame(list(rows), FILE_EVENTS).coalesce(1).write.mode("append").parquet(source)
        query = S.sync_catalog(S.quiet_events(S.read_events(spark, source), gap="1 hour"), root, "/links", V.ts(V.NOW), checkpoint, 0)
        query.awaitTermination()
        assert [spark.conf.get(name, None) for name in names] == before
        return {path.suffix for path in (tmp_path / name / "cp" / "state").rglob("*.*") if path.suffix in (".delta", ".zip")}, sorted(
            (r["src_path"], r["size"]) for r in S.open_modifications(spark, checkpoint).collect())

    a, b = path("S1", "B1", "a.pod5"), path("S1", "B1", "b.pod5")
    first, second = (event("modified", a, 1, 10), event("modified", b, 1, 7)), (event("modified", a, 2, 20), event("deleted", b, 3))
    assert drop("new", *first) == ({".zip"}, [(a, 10), (b, 7)])
    assert drop("new", *second) == ({".zip"}, [(a, 20)])
    with monkeypatch.context() as patched:
        patched.setattr(S, "_ON_DISK", {})
        assert drop("old", *first) == ({".delta"}, [(a, 10), (b, 7)])
    assert drop("old", *second) == ({".delta"}, [(a, 20)])
