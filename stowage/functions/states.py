"""State mappings and fields of the cluster's job listing."""

from pyspark.sql import Column, functions as F

# Exit codes with a meaning of their own.
EXIT_STATES = {0: "COMPLETED", 124: "TIMEOUT"}


def exit_status(exit_code: Column) -> Column:
    state = F.when(exit_code.isNull(), "UNKNOWN")
    for code, name in EXIT_STATES.items():
        state = state.when(exit_code == code, name)
    return state.otherwise("FAILED")


def live_task_status(job_status: Column) -> Column:
    """A task whose job is still listed."""
    return F.when(job_status == "RUNNING", "processing").otherwise("queued")


def final_task_status(job_status: Column) -> Column:
    """A task whose job has left the listing."""
    return F.when(job_status == "COMPLETED", "completed").otherwise("failed")


def submitted_job_id(stdout: Column) -> Column:
    """The job id out of ``Submitted batch job N``; 0 when no line has exactly that form."""
    found = F.regexp_extract(stdout, r"(?m)^[ \t]*Submitted batch job[ \t]+([0-9]+)[ \t\r]*$", 1)
    return F.coalesce(found.try_cast("bigint"), F.lit(0).cast("bigint"))


def parent_job_id(comment: Column) -> Column:
    bare = F.regexp_replace(comment, "^parent_job_id ", "")
    return F.coalesce(bare.try_cast("bigint"), F.lit(0).cast("bigint"))


def node_list(nodes: Column) -> Column:
    return F.split(F.coalesce(nodes, F.lit("")), ",")


def last_state(states: Column) -> Column:
    return F.try_element_at(states, F.lit(-1))


def stream_path(path: Column) -> Column:
    return F.when(path == "/dev/null", "").otherwise(path)


def running_time(status: Column, seconds: Column) -> Column:
    """An epoch time that only means something while the job runs; 0 is absent."""
    return F.when((status == "RUNNING") & (seconds != 0), F.timestamp_seconds(seconds))
