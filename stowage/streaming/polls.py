"""The scheduling cycle driven by a stream of job snapshots."""

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.jobs import normalise_jobs
from ..plans.scheduling import committed, run_stored_cycle
from ..schemas import JOB_SNAPSHOT

# Fixed value: the default time between two cycles.
POLL_INTERVAL = "10 seconds"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Job listings dropped into a folder as JSON documents; each is one micro-batch."""
    return (spark.readStream.schema(JOB_SNAPSHOT).option("multiLine", True)
            .option("maxFilesPerTrigger", 1).json(path))


def schedule(snapshots: DataFrame, root: str, inputs: Callable[[SparkSession], dict], first_version: int,
             checkpoint: str, once: bool = True, interval: str = POLL_INTERVAL) -> StreamingQuery:
    """Run a cycle per snapshot: micro-batch ``n`` is cycle ``first_version + n``, finished ones are skipped.

    ``inputs`` gives the other arguments of ``run_stored_cycle`` as they are at that time.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, first_version + batch_id
        if version > committed(spark, root):
            jobs = normalise_jobs(batch.select(F.inline("jobs")))
            run_stored_cycle(spark, root, jobs, version=version, **inputs(spark))

    writer = snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
