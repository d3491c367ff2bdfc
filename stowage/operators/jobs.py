"""Cluster jobs and the tasks they run."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.documents import put_key
from ..functions.durations import elapsed, latest
from ..functions.states import (
    exit_status, final_task_status, last_state, live_task_status, node_list, parent_job_id,
    running_time, stream_path,
)
from .ordered import DAY, with_neighbours
from .rollup import paged
from .work import IN_QUEUE


def normalise_jobs(raw: DataFrame) -> DataFrame:
    """The cluster's job listing as typed rows; entries without an id are dropped."""
    status = last_state(F.col("job_state"))
    return raw.filter(F.coalesce("job_id", F.lit(0)) != 0).select(
        "job_id", F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("array_job_id.number", F.lit(0).cast("bigint")).alias("array_job_id"),
        parent_job_id(F.col("comment")).alias("parent_job_id"),
        node_list(F.col("nodes")).alias("nodes"), "partition",
        F.coalesce("priority.number", F.lit(0).cast("bigint")).alias("priority"),
        status.alias("status"),
        stream_path(F.col("standard_error")).alias("stderr"),
        stream_path(F.col("standard_output")).alias("stdout"),
        F.col("exit_code.number").cast("int").alias("exit_code"),
        F.col("current_working_directory").alias("work_dir"),
        running_time(status, F.col("start_time.number")).alias("start"),
        running_time(status, F.col("end_time.number")).alias("limit"),
    )


def child_jobs(jobs: DataFrame) -> DataFrame:
    """Child jobs whose parent is in the listing, one row per child.

    A parent may own any share of the jobs, so children stay rows. Parents are as many as jobs, too
    many to salt; a skewed child partition is split by adaptive execution.
    """
    parents = jobs.select(F.col("job_id").alias("parent_job_id"), F.col("name").alias("parent_name"))
    return jobs.filter("parent_job_id != 0").join(parents, "parent_job_id")


def child_counts(jobs: DataFrame) -> DataFrame:
    """Children per listed parent; they are counted before parents are looked up."""
    counts = jobs.filter("parent_job_id != 0").groupBy("parent_job_id").agg(
        F.count(F.lit(1)).alias("n_children"),
        F.sum(F.when(F.col("status") == "RUNNING", 1).otherwise(0)).alias("n_running"))
    return counts.join(jobs.select(F.col("job_id").alias("parent_job_id")), "parent_job_id", "left_semi")


def child_map(jobs: DataFrame, page_size: int = 1000) -> DataFrame:
    """``{child id: job}`` per parent in pages of about ``page_size``; a small parent has page 0 only."""
    entry = F.struct("job_id", F.struct("name", "status", "exit_code", "work_dir"))
    children = jobs.filter("parent_job_id != 0").groupBy("parent_job_id").agg(F.count(F.lit(1)).alias("n"))
    pages = paged(child_jobs(jobs), "parent_job_id", F.col("job_id").cast("string"), page_size, children)
    return pages.groupBy("parent_job_id", "page").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("child_jobs"))


def enrich_tasks(tasks: DataFrame, samples: DataFrame, results: DataFrame) -> DataFrame:
    """Tasks with their sample and result documents, null where there is none.

    The documents meet first, one row a sample, so that tasks are joined once and a sample that has many of them can
    be split.
    """
    def documents(df, name):
        return df.select("sample_id", F.struct(*[c for c in df.columns if c != "sample_id"]).alias(name))

    both = documents(samples, "sample_meta").join(documents(results, "result_meta"), "sample_id", "full_outer")
    return tasks.join(both, "sample_id", "left")


def reference_documents(enriched: DataFrame) -> DataFrame:
    """The form tasks are stored in: the embedded documents give way to the sample id they share."""
    return enriched.drop("sample_meta", "result_meta")


def tasks_in(tasks: DataFrame, statuses) -> DataFrame:
    return tasks.filter(F.col("status").isin(*statuses) & F.col("sample_id").isNotNull())


def queue_task(tasks: DataFrame, admitted: DataFrame, now: Column) -> DataFrame:
    """Tasks that were handed a job id (``task_id, job_id``) become queued; id 0 is a failed hand-over."""
    given = admitted.select("task_id", F.col("job_id").alias("_job"))
    joined = tasks.drop("job_id").join(given, "task_id")
    ok = F.col("_job") != 0
    return joined.withColumns({
        "status": F.when(ok, "queued").otherwise("failed"),
        "queued": F.when(ok, now).otherwise(F.col("queued")),
        "time_in_processing": F.when(ok, "00:00:00"),
        "job_id": F.col("_job"),
    }).drop("_job")


def reconcile(tasks: DataFrame, jobs: DataFrame, exit_codes: DataFrame, now: Column, flag: str | None = None) -> DataFrame:
    """The next state of every task, given the current job listing; ``flag`` names a column that tells which were judged.

    A queued or processing task whose job is listed follows it; one whose job is gone is finished and
    judged by its exit code (``job_id, exit_code``), a missing code counting as failure. Other tasks,
    and tasks that never had a job, come through unchanged and stay out of the joins. Of a job that is listed more than once the
    row with the latest start counts, then with the latest limit; of several exit codes of a job the greatest.
    """
    running = F.col("status").isin(*IN_QUEUE) & F.col("job_id").isNotNull()
    held = tasks.filter(~F.coalesce(running, F.lit(False)))
    # Most jobs listed are children or others' jobs: those of no running task go before they are grouped.
    asked = jobs.join(tasks.filter(running).select("job_id"), "job_id", "left_semi")
    listed = asked.groupBy("job_id").agg(F.max(F.struct("start", "limit", "status")).alias("_j")).select(
        "job_id", F.col("_j.status").alias("_status"), F.col("_j.start").alias("_start"), F.col("_j.limit").alias("_limit"),
        F.lit(True).alias("_listed"))
    codes = exit_codes.groupBy("job_id").agg(F.max("exit_code").alias("_code"))
    joined = tasks.filter(running).join(listed, "job_id", "left").join(codes, "job_id", "left")

    live = F.col("_listed").isNotNull()
    end_status = exit_status(F.col("_code"))
    old = {c: (F.col(c) if c in tasks.columns else F.lit(None).cast("timestamp"))
           for c in ("start", "limit", "finish")}
    followed = joined.select(
        *[F.col(c) for c in tasks.columns if c not in _RECONCILED],
        F.when(live, live_task_status(F.col("_status"))).otherwise(final_task_status(end_status)).alias("status"),
        F.when(live, F.col("_status")).otherwise(end_status).alias("job_status"),
        F.when(live, F.coalesce(old["start"], F.col("_start"))).otherwise(old["start"]).alias("start"),
        F.when(live, F.coalesce(old["limit"], F.col("_limit"))).otherwise(old["limit"]).alias("limit"),
        F.when(live, old["finish"]).otherwise(now).alias("finish"),
        F.when(live, F.lit(None)).otherwise(F.col("_code")).cast("int").alias("exit_code"),
        now.alias("last_update"),
        elapsed(F.col("created"), now).alias("time_from_creation_to_finish"),
        F.when(live | F.col("queued").isNotNull(), elapsed(F.col("queued"), now)).alias("time_in_processing"),
    )
    if flag:
        held, followed = held.withColumn(flag, F.lit(False)), followed.withColumn(flag, F.lit(True))
    return held.unionByName(followed, allowMissingColumns=True)


_RECONCILED = ("status", "job_status", "start", "limit", "finish", "exit_code", "last_update",
               "time_from_creation_to_finish", "time_in_processing")


def finished(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tasks that left the queue in this pass."""
    was = before.filter(F.col("status").isin(*IN_QUEUE)).select("task_id")
    return after.filter(F.col("status").isin("completed", "failed")).join(was, "task_id", "left_semi")


def drop_finished(queued: DataFrame, done: DataFrame) -> DataFrame:
    return queued.join(done.select("task_id"), "task_id", "left_anti")


def record_in_samples(samples: DataFrame, tasks: DataFrame) -> DataFrame:
    """Write each task's state into its sample's ``tasks`` map, under its pipeline.

    Tasks of one sample are at most one per pipeline, and pipelines are configuration; the newest
    state per (sample, pipeline) is taken before a sample's entries are gathered.
    """
    when = F.struct(latest(F.col("last_update"), F.col("created")), F.col("task_id"))
    newest = tasks.groupBy("sample_id", "pipeline_id").agg(
        F.max_by(F.struct("task_id", "status"), when).alias("t"))
    states = newest.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct(
        "pipeline_id", F.create_map(F.col("t.task_id"), F.col("t.status"))))).alias("_new"))
    joined = samples.join(states, "sample_id", "left")
    kept = F.map_filter("tasks", lambda k, _: ~F.map_contains_key(F.col("_new"), k))
    merged = F.when(F.col("_new").isNull(), F.col("tasks")).when(
        F.col("tasks").isNull(), F.col("_new")).otherwise(F.map_concat(kept, F.col("_new")))
    return joined.withColumn("tasks", merged).drop("_new").select(*samples.columns)


def record_state(mapping: Column, pipeline_id: Column, task: Column, status: Column) -> Column:
    """One task's state put into a ``{pipeline: {task: status}}`` map."""
    return put_key(mapping, pipeline_id, F.create_map(task, status))


def state_transitions(polls: DataFrame, key: str = "task_id", order: str = "polled_at",
                      bucket_seconds: int = DAY) -> DataFrame:
    """Rows where a task's status differs from the poll before, with both; the first poll counts."""
    near = with_neighbours(polls, [key], order, [F.col("status").alias("status")], before="_before", tie=["status"],
                           bucket_seconds=bucket_seconds)
    moved = near.withColumn("previous_status", F.col("_before.status")).drop("_before")
    return moved.filter(~F.col("previous_status").eqNullSafe(F.col("status")))
