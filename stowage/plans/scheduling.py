"""One scheduling cycle: reconcile, create, shape, admit; and the same over stored tables."""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators import jobs as J, outputs as O, versions as V, work as W
from ..operators.shapers import Shapers
from ..session import fixed, intermediates, written
from ..sources import tables
from ..sources.rules import masks_of

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()
TASKS = T.StructType([T.StructField(n, t) for n, t in dict(
    task_id=_S, sample_id=_S, pipeline_id=_S, status=_S, sorting=_S, timeout=_S, input_files_size=_L, command=_S,
    reasons=T.ArrayType(_S), created=_TS, queued=_TS, job_id=_L, job_status=_S, start=_TS, limit=_TS, finish=_TS,
    exit_code=T.IntegerType(), last_update=_TS, time_from_creation_to_finish=_S, time_in_processing=_S).items()])
SAMPLE_TASKS = T.StructType([
    T.StructField("sample_id", _S), T.StructField("tasks", T.MapType(_S, T.MapType(_S, _S)))])
CHILDREN = T.StructType([T.StructField(n, t) for n, t in dict(
    task_id=_S, job_id=_L, name=_S, status=_S, exit_code=T.IntegerType(), work_dir=_S).items()])
RESULTS = T.StructType([T.StructField(n, _S) for n in ("sample_id", "pipeline_id", "task_id", "group", "type", "value")])
ADMITTED = T.StructType([
    T.StructField("task_id", _S), T.StructField("sorting", _S), T.StructField("rank", _L),
    T.StructField("job_id", _L)])


@dataclass(frozen=True)
class Cycle:
    """What a cycle decides."""

    tasks: DataFrame      # all tasks in their next state, new ones included, ``changed`` marked; written once
    finished: DataFrame   # tasks that left the queue in this cycle
    rejected: DataFrame   # candidates that lack a sample or result document
    admitted: DataFrame   # prepared tasks that get a slot now, ranked per queue


def run_cycle(tasks: DataFrame, jobs: DataFrame, exit_codes: DataFrame, samples: DataFrame,
              results: DataFrame, rules: list[dict], rules_table: DataFrame, shapers: Shapers,
              capacity: dict[str, int], now: Column) -> Cycle:
    """Nothing is launched: the admitted tasks are the output, ``jobs.queue_task`` records job ids."""
    reconciled = J.reconcile(tasks, jobs, exit_codes, now, flag="changed")
    found = W.candidates(samples, rules, tasks)
    created = W.new_tasks(found, samples, results, rules_table, now)
    shaped = shapers.shape_inputs(created).select(
        "task_id", "sample_id", "pipeline_id", "sorting", "timeout", "status", "created", "last_update", "command",
        F.col("input_files_size").cast("bigint").alias("input_files_size"), "reasons", F.lit(True).alias("changed"))
    # Admission and the finished list read the table of next states and do not derive it again.
    everything = written(reconciled.unionByName(shaped, allowMissingColumns=True), "tasks")
    return Cycle(
        tasks=everything,
        finished=J.finished(tasks, everything),
        rejected=W.without_documents(found, samples, results),
        admitted=W.admit(everything, capacity),
    )


def read_tasks(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    return tables.read_live(spark, root, "tasks", TASKS, "task_id", upto)


def read_sample_tasks(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Each sample's ``{rule: {task: status}}`` map."""
    return tables.read_live(spark, root, "sample_tasks", SAMPLE_TASKS, "sample_id", upto)


def read_children(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The child jobs of stored tasks, each as last seen."""
    return tables.read_live(spark, root, "children", CHILDREN, ["task_id", "job_id"], upto)


def read_results(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """What completed tasks put out: one row per task, pipeline, group, type and value."""
    return tables.read_live(spark, root, "results", RESULTS, ["task_id", "group", "type", "value"], upto)


def committed(spark: SparkSession, root: str) -> int:
    return tables.latest_version(spark, root, "cycles")


def _children(tasks, jobs):
    """Child jobs in the listing of tasks that hold a slot. A task may have any number; they stay rows."""
    heads = tasks.filter(F.col("status").isin(*W.IN_QUEUE) & F.col("job_id").isNotNull()).select(
        "task_id", F.col("job_id").alias("parent_job_id"))
    if "parent_job_id" not in jobs.columns:
        return _fit(heads.limit(0), CHILDREN)
    return _fit(jobs.filter("parent_job_id != 0").join(heads, "parent_job_id"), CHILDREN)


def _outputs(done, listing, rules, rules_table, shapers):
    """Files found for completed tasks, the shapers' values in place of those of the same group and type."""
    known = done.select("task_id", "sample_id", "pipeline_id")
    masks = rules_table.select("pipeline_id", F.inline("expected_output"))
    expected = known.join(masks, "pipeline_id").select("task_id", "group", "type", "mask")
    shaped = shapers.shape_outputs(done) if shapers else None
    if listing is None or not masks_of(rules):
        found = expected.limit(0).select("task_id", "group", "type", F.lit("").alias("value"))
    else:
        found = O.match_outputs(expected, listing, masks_of(rules)).select(
            "task_id", "group", "type", F.col("filepath").alias("value"))
    if shaped is not None:
        slots = shaped.select("task_id", "group", "type").distinct()
        found = found.join(slots, O.SLOT, "left_anti").unionByName(shaped.select("task_id", "group", "type", "value"))
    return _fit(found.join(known, "task_id"), RESULTS)


def _fit(df, schema):
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def run_stored_cycle(spark: SparkSession, root: str, jobs: DataFrame, exit_codes: DataFrame, samples: DataFrame,
                     results: DataFrame, rules: list[dict], rules_table: DataFrame, shapers: Shapers,
                     capacity: dict[str, int], now: Column, hand_over: Callable[[DataFrame], DataFrame],
                     version: int | None = None, listing: DataFrame | None = None) -> int:
    """A cycle over the stored tasks; the rows it changes are appended as one version.

    Tasks that complete in it have their outputs looked up in ``listing`` (task_id, filepath, size, is_file) by the
    masks of their rule, overlaid with what the rule's shaper gives, and stored in ``results`` under their pipeline.
    The jobs that a running task's head job started are kept in ``children``.

    ``samples`` are the sample documents without their ``tasks``, which are kept here. ``hand_over``
    turns admitted tasks into (task_id, job_id) rows, 0 where the cluster refused. It is asked once
    per version; the answer is written first, so a repeated pass does not hand a task over again.
    """
    version = committed(spark, root) + 1 if version is None else version
    now = fixed(spark, now)
    with intermediates(spark):
        return _stored_cycle(spark, root, jobs, exit_codes, samples, results, rules, rules_table, shapers, capacity, now,
                             hand_over, version, listing)


def _stored_cycle(spark, root, jobs, exit_codes, samples, results, rules, rules_table, shapers, capacity, now, hand_over,
                  version, listing):
    before = version - 1
    stored = read_tasks(spark, root, before)
    states = read_sample_tasks(spark, root, before)
    documents = samples.join(states, "sample_id", "left")
    cycle = run_cycle(stored, jobs, exit_codes, documents, results, rules, rules_table, shapers, capacity, now)
    if tables.latest_version(spark, root, "admitted") < version:
        admitted = written(cycle.admitted, "admitted")
        given = admitted.select("task_id", "sorting", "rank").join(
            hand_over(admitted).select("task_id", "job_id"), "task_id")
        tables.finish(_fit(given, ADMITTED), root, "admitted", version)
    given = tables.read_finished(spark, root, "admitted", ADMITTED, version).select("task_id", "job_id")
    moved = cycle.tasks.filter("changed")
    queued = J.queue_task(_fit(cycle.tasks, TASKS), given, now).withColumn("last_update", now)
    changed = written(V.live(
        _fit(moved, TASKS).withColumn("_step", F.lit(0)).unionByName(_fit(queued, TASKS).withColumn("_step", F.lit(1))),
        "task_id", "_step").drop("_step"), "changed-tasks")
    tables.append_rows(changed, root, "tasks", version)
    tables.append_rows(_children(stored, jobs), root, "children", version)
    done = cycle.finished.filter("status = 'completed'")
    tables.append_rows(_outputs(done, listing, rules, rules_table, shapers), root, "results", version)
    touched = documents.join(changed.select("sample_id"), "sample_id", "left_semi")
    tables.append_rows(_fit(J.record_in_samples(touched, changed), SAMPLE_TASKS), root, "sample_tasks", version)
    tables.finish(changed.groupBy("status").agg(F.count(F.lit(1)).alias("n")), root, "cycles", version)
    return version
