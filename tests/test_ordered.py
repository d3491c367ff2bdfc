"""Ordered operators against plain windows, with one key holding most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from stowage.operators import jobs, ordered, versions

START = datetime(2024, 1, 1)
HOUR = 3600


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(4)
    rows = [(i, None if i % 97 == 0 else ("hot" if rng.random() < 0.6 else f"k{rng.randrange(9)}"),
             START + timedelta(minutes=rng.randrange(60 * 24 * 20)), rng.choice("abc")) for i in range(1500)]
    return spark.createDataFrame(rows, "id int, key string, ts timestamp, status string").cache()


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("bucket", [HOUR, ordered.DAY, 400 * ordered.DAY])
def test_neighbours_are_those_of_a_plain_window(events, bucket):
    window = Window.partitionBy("key").orderBy("ts", "id")
    plain = events.select("id", F.lag("status").over(window), F.lead("id").over(window))
    both = ordered.with_neighbours(events, ["key"], "ts", [F.col("status"), F.col("id")], before="b", after="a",
                                   tie=["id"], bucket_seconds=bucket)
    assert rows(both.select("id", "b.status", "a.id")) == rows(plain)


def bursts(events, gap):
    """Bursts in plain Python: a later event within the gap belongs to the one before."""
    out, by_key = [], {}
    for r in events.collect():
        by_key.setdefault(r["key"], []).append((r["ts"], r["id"]))
    for key, items in by_key.items():
        current = []
        for item in sorted(items):
            if current and (item[0] - current[-1][0]).total_seconds() > gap:
                out.append((key, current))
                current = []
            current.append(item)
        out.append((key, current))
    return out


@pytest.mark.parametrize("gap", [600, 2 * HOUR, 12 * HOUR])
def test_sessions_and_debounce(events, gap):
    expected = bursts(events, gap)
    found = ordered.sessions(events, ["key"], "ts", gap, [F.count(F.lit(1)).alias("n")], tie=["id"])
    assert rows(found.select("key", "session_start", "session_end", "n")) == sorted(
        ((k, b[0][0], b[-1][0], len(b)) for k, b in expected), key=repr)
    kept = ordered.settled(events, ["key"], "ts", gap, tie=["id"])
    assert sorted(r["id"] for r in kept.collect()) == sorted(b[-1][1] for _, b in expected)


def test_an_event_exactly_one_gap_later_continues_the_burst(spark):
    frame = spark.createDataFrame([(1, "k", START), (2, "k", START + timedelta(seconds=5))], "id int, key string, ts timestamp")
    assert [r["id"] for r in ordered.settled(frame, ["key"], "ts", 5).collect()] == [2]
    assert ordered.settled(frame, ["key"], "ts", 4.999).count() == 2


@pytest.mark.parametrize("bucket", [600, HOUR, 30 * ordered.DAY])
def test_sessions_across_many_buckets(events, bucket):
    found = ordered.sessions(events, ["key"], "ts", 3 * HOUR, [F.sum("id").alias("n")], tie=["id"], bucket_seconds=bucket)
    assert rows(found.select("key", "session_start", "n")) == sorted(
        ((k, b[0][0], sum(i for _, i in b)) for k, b in bursts(events, 3 * HOUR)), key=repr)


def test_rows_are_windowed_by_key_and_bucket(events):
    """The only window over a bare key runs over one row per (key, bucket), gathered map-side."""
    frame = ordered.with_neighbours(events, ["key"], "ts", [F.col("id")], before="b", tie=["id"])
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("_bucket" in line.split("], [")[1] for line in windows) == 1
    physical = frame._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max_by" in physical


def test_version_chain_links_both_ways(spark):
    frame = spark.createDataFrame(
        [("l", "A", START), ("l", "B", START + timedelta(days=40)), ("l", "A", START + timedelta(days=90)), ("m", "X", START)],
        "symlink string, fingerprint string, observed_at timestamp")
    chain = versions.version_chain(frame, "symlink", "observed_at").orderBy("symlink", "observed_at").collect()
    assert [(r["previous_version"], r["fingerprint"], r["next_version"]) for r in chain] == [
        (None, "A", "B"), ("A", "B", "A"), ("B", "A", None), (None, "X", None)]


def test_state_transitions(events):
    polls = events.filter("key is not null").select(
        F.col("key").alias("task_id"), "status", (F.col("ts") + F.make_dt_interval(secs=F.col("id") / 1e4)).alias("polled_at"))
    window = Window.partitionBy("task_id").orderBy("polled_at")
    plain = polls.withColumn("p", F.lag("status").over(window)).filter(~F.col("p").eqNullSafe(F.col("status")))
    found = jobs.state_transitions(polls)
    assert rows(found.select("task_id", "polled_at", "previous_status", "status")) == rows(
        plain.select("task_id", "polled_at", "p", "status"))


def test_rows_without_a_time_are_neighbours_too(spark):
    rows = spark.createDataFrame([("k", None, 1, "a"), ("k", START, 2, "b"), ("k", None, 3, "c"), (None, None, 4, "d")],
                                 "key string, ts timestamp, id int, status string")
    near = ordered.with_neighbours(rows, ["key"], "ts", [F.col("id")], before="b", after="a", tie=["id"])
    assert sorted((r["id"], r["b"] and r["b"]["id"], r["a"] and r["a"]["id"]) for r in near.collect()) == [
        (1, None, 3), (2, 3, None), (3, 1, 2), (4, None, None)]
    assert sorted(r["id"] for r in ordered.settled(rows, ["key"], "ts", 60, tie=["id"]).collect()) == [1, 2, 3, 4]
    found = ordered.sessions(rows, ["key"], "ts", 60, [F.count(F.lit(1)).alias("n")], tie=["id"]).collect()
    assert sorted((r["key"] or "", r["session_start"] is None, r["n"]) for r in found) == [("", True, 1), ("k", False, 1), ("k", True, 2)]


def test_one_key_with_a_third_of_all_rows(spark):
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 50)) AS key", "id",
                                        "timestamp_seconds(id * 977 % 500000) AS ts", "concat('s', id % 3) AS status")
    plain = Window.partitionBy("key").orderBy("ts", "id")
    expected = {r["id"]: r["p"] for r in rows.select("id", F.lag("id").over(plain).alias("p")).collect()}
    near = ordered.with_neighbours(rows, ["key"], "ts", [F.col("id")], before="b", tie=["id"], bucket_seconds=3600)
    assert {r["id"]: r["b"] and r["b"]["id"] for r in near.collect()} == expected


def test_a_chain_brings_each_fingerprint_to_the_borders_once(events):
    """The ends of a bucket are their place in the order, which has the fingerprint; no second copy goes beside it."""
    chain = versions.version_chain(events, "key", "ts", "status", bucket_seconds=HOUR)
    plan = chain._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and "min_by" not in plan
    window = Window.partitionBy("key").orderBy("ts", "status")
    plain = events.select("id", "status", F.lag("status").over(window), F.lead("status").over(window))
    # Rows of one time and one status are interchangeable.
    assert sorted((tuple(r)[1:] for r in plain.collect()), key=repr) == sorted(
        (tuple(r) for r in chain.select("status", "previous_version", "next_version").collect()), key=repr)
