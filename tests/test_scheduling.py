"""Stored scheduling cycles driven by job snapshots."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stowage.functions import documents
from stowage.operators.shapers import Shapers
from stowage.plans import scheduling as P
from stowage.schemas import ENTITIES
from stowage.sources import rules as R
from stowage.streaming import polls

RULES = {"call_v1": {"name": "call", "version": "v1", "sorting": "SJF", "timeout": "01:00",
                     "conditions": [{"field": "size", "type": "gte", "value": 10}]}}


def inputs(spark):
    samples = spark.createDataFrame(
        [("S1", "indexed", 10), ("S2", "indexed", 30), ("S3", "indexed", 20), ("S4", "indexed", 5),
         ("S5", "deprecated", 50), ("S6", "indexed", 60)], "sample_id string, status string, size long")
    results = spark.createDataFrame([(f"S{i}",) for i in range(1, 6)], "sample_id string")
    registry = Shapers()
    registry.register("call_v1", lambda t: t.join(samples.select("sample_id", F.col("size").alias("input_files_size")), "sample_id")
                      .withColumns({"command": F.lit("run"), "n_groups": F.lit(1), "n_expected": F.lit(1)}),
                      lambda t: t.select("task_id", F.lit("sum").alias("group"), F.lit("n").alias("type"), F.lit("7").alias("value")))
    codes = spark.createDataFrame([(101, 0), (103, 124)], "job_id long, exit_code int")
    return dict(
        exit_codes=codes, samples=samples, results=results, rules=R.normalise_rules(RULES),
        rules_table=R.load_rules(spark, RULES), shapers=registry, capacity={"SJF": 2, "LJF": 1},
        now=F.current_timestamp(),
        hand_over=lambda admitted: admitted.select(
            "task_id", (F.lit(100) + F.substring("sample_id", 2, 1).cast("long")).alias("job_id")))


def test_cycles_follow_the_snapshots(spark, tmp_path):
    root, source = str(tmp_path / "root"), tmp_path / "snapshots"
    source.mkdir()

    def poll(number, *jobs, checkpoint="cp"):
        listed = [{"job_id": j, "job_state": [s], "start_time": {"number": 60}} for j, s in jobs]
        (source / f"{number}.json").write_text(json.dumps({"jobs": listed}))
        run(checkpoint)
        return {r["sample_id"]: r["status"] for r in P.read_tasks(spark, root).collect()}

    def run(checkpoint="cp"):
        polls.schedule(polls.read_snapshots(spark, str(source)), root, inputs, 0, str(tmp_path / checkpoint)).awaitTermination()

    # S1 and S3 have the smallest inputs and take the two slots; S6 has no result document.
    assert poll(0) == {"S1": "queued", "S3": "queued", "S2": "prepared"}
    assert poll(1, (101, "RUNNING"), (103, "PENDING")) == {"S1": "processing", "S3": "queued", "S2": "prepared"}
    # S1's job is gone with code 0: its slot goes to S2.
    assert poll(2, (103, "RUNNING")) == {"S1": "completed", "S3": "processing", "S2": "queued"}
    assert poll(3, (102, "RUNNING")) == {"S1": "completed", "S3": "failed", "S2": "processing"}
    rows = {r["sample_id"]: r for r in P.read_tasks(spark, root).collect()}
    assert rows["S1"]["exit_code"] == 0 and rows["S3"]["job_status"] == "TIMEOUT"
    assert rows["S2"]["start"] is not None and rows["S1"]["finish"] is not None
    assert [tuple(r) for r in P.read_results(spark, root).collect()] == [("S1", "call_v1", "S1_call_v1", "sum", "n", "7")]
    states = {r["sample_id"]: r["tasks"] for r in P.read_sample_tasks(spark, root).collect()}
    assert states["S1"] == {"call_v1": {"S1_call_v1": "completed"}} and set(states) == {"S1", "S2", "S3"}
    # Replaying all snapshots with a fresh checkpoint finds every cycle finished.
    run("cp2")
    assert P.committed(spark, root) == 3
    assert {r["sample_id"]: r["status"] for r in P.read_tasks(spark, root).collect()} == {
        "S1": "completed", "S3": "failed", "S2": "processing"}


def test_a_repeated_cycle_does_not_hand_over_again(spark, tmp_path):
    root, asked = str(tmp_path), []
    jobs = spark.createDataFrame([], "job_id long, status string, start timestamp, limit timestamp")
    given = inputs(spark)
    first = given["hand_over"]
    given["hand_over"] = lambda admitted: asked.append(1) or first(admitted)
    P.run_stored_cycle(spark, root, jobs, version=0, **given)
    P.run_stored_cycle(spark, root, jobs, version=0, **given)
    assert asked == [1]
    assert sorted(r["status"] for r in P.read_tasks(spark, root).collect()) == ["prepared", "queued", "queued"]


def test_child_jobs_stay_with_their_task(spark, tmp_path):
    root = str(tmp_path)
    kind = "job_id long, parent_job_id long, name string, status string, exit_code int, work_dir string, start timestamp, limit timestamp"
    given = inputs(spark)
    none = spark.createDataFrame([], kind)
    listed = spark.createDataFrame([(101, 0, "h", "RUNNING", None, "/w", None, None), (7, 101, "c1", "RUNNING", None, "/w7", None, None),
                                    (8, 101, "c2", "PENDING", None, "/w8", None, None), (9, 999, "x", "RUNNING", None, "/w9", None, None)], kind)
    later = listed.filter("job_id in (101, 8)").withColumn("status", F.lit("RUNNING"))
    for jobs in (none, listed, later):
        P.run_stored_cycle(spark, root, jobs, **given)
    rows = {r["job_id"]: (r["task_id"], r["status"]) for r in P.read_children(spark, root).collect()}
    assert rows == {7: ("S1_call_v1", "RUNNING"), 8: ("S1_call_v1", "RUNNING")}


@pytest.mark.parametrize("entity", sorted(ENTITIES))
def test_every_entity_reads_an_empty_document_and_writes_it_back(spark, entity):
    schema, defaults = ENTITIES[entity]
    rows = documents.read_entities(spark.createDataFrame([("{}",)], "doc string"), "doc", entity)
    assert rows.schema.names == schema.names
    row = rows.first().asDict()
    assert {k: row[k] for k in defaults} == defaults
    again = documents.read_entities(documents.to_documents(rows, "doc"), "doc", entity)
    assert again.first().asDict() == row


def test_times_survive_the_document_form(spark):
    at = datetime(2024, 5, 1, 12, 30)
    frame = spark.createDataFrame([("b", at)], "name string, created timestamp")
    assert documents.read_entities(documents.to_documents(frame, "doc"), "doc", "batches").first()["created"] == at
