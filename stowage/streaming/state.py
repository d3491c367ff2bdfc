"""Keyed state that lives between micro-batches, as stored tables.

Each micro-batch is a pass over the keys it names: their last state is read, the rows that follow from it are
appended, and so is the new state. Passes are numbered; one that is repeated writes the same again, one
that was finished before a restart is skipped.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ordered import DAY, with_neighbours
from ..session import intermediates, written
from ..sources import tables
from .events import FLUSH_INTERVAL

_S, _L = T.StringType(), T.LongType()
LAST = T.StructType([T.StructField("task_id", _S), T.StructField("polled_at", T.TimestampType()), T.StructField("status", _S)])
TRANSITIONS = T.StructType([
    T.StructField("task_id", _S), T.StructField("polled_at", T.TimestampType()),
    T.StructField("previous_status", _S), T.StructField("status", _S)])
TOTALS = T.StructType([
    T.StructField("name", _S), T.StructField("n_files", _L), T.StructField("size", _L), T.StructField("origin", _S)])
PRESENT = T.StructType([
    T.StructField("filepath", _S), T.StructField("ts", T.TimestampType()), T.StructField("present", T.BooleanType())])


def _started(stream, apply, root, name, checkpoint, first_version, once, interval) -> StreamingQuery:
    finished = f"{name}_passes"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, first_version + batch_id
        if version > tables.latest_version(spark, root, finished):
            with intermediates(spark):
                rows = written(batch, "batch")
                apply(spark, rows, version)
                tables.finish(rows.agg(F.count(F.lit(1)).alias("n")), root, finished, version)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def _known(spark, root, table, schema, key, upto, batch) -> DataFrame:
    """The stored rows of the keys that a micro-batch names; only their buckets are opened."""
    at = tables.buckets_of(batch, at=tables.bucket(key))["at"]
    return tables.read_live(spark, root, table, schema, key, upto, batch.select(key).distinct(), buckets=at)


def track_transitions(polls: DataFrame, root: str, checkpoint: str, first_version: int = 0, once: bool = True,
                      interval: str = FLUSH_INTERVAL, bucket_seconds: int = DAY) -> StreamingQuery:
    """Status changes of tasks across polls (``task_id, polled_at, status``), kept below ``root``.

    A poll is compared with the one before it in its micro-batch, the first of a task with the task's stored
    status. Polls are ordered by time, then status.
    """
    def apply(spark, batch, version):
        before = _known(spark, root, "last_status", LAST, "task_id", version - 1, batch)
        # The stored row has no time here and so comes first.
        rows = batch.select("task_id", "polled_at", "status", F.lit(False).alias("_old")).unionByName(
            before.select("task_id", F.lit(None).cast("timestamp").alias("polled_at"), "status", F.lit(True).alias("_old")))
        near = with_neighbours(rows, ["task_id"], "polled_at", [F.col("status").alias("status")], before="_before",
                               tie=[~F.col("_old"), F.col("status")], bucket_seconds=bucket_seconds)
        moved = near.filter(~F.col("_old") & ~F.col("_before.status").eqNullSafe(F.col("status"))).select(
            "task_id", "polled_at", F.col("_before.status").alias("previous_status"), "status")
        last = batch.groupBy("task_id").agg(F.max(F.struct("polled_at", "status")).alias("l")).select("task_id", "l.*")
        tables.append_rows(last, root, "last_status", version, tables.bucket("task_id"))
        tables.append_rows(moved, root, "transitions", version)

    return _started(polls, apply, root, "transitions", checkpoint, first_version, once, interval)


def read_transitions(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_rows(spark, root, "transitions", TRANSITIONS).drop("as_of")


def track_totals(deltas: DataFrame, stored: DataFrame, root: str, checkpoint: str, first_version: int = 0,
                 once: bool = True, interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Current totals of every entity, kept below ``root``, beginning with the stored catalog's.

    ``deltas`` streams (name, n_files, size) signed contributions; ``stored`` is a batch DataFrame of (name, n_files, size).
    """
    def apply(spark, batch, version):
        summed = batch.groupBy("name").agg(F.sum("n_files").alias("_n"), F.sum("size").alias("_size"))
        names = summed.select("name")
        known = _known(spark, root, "totals", TOTALS, "name", version - 1, batch)
        first = stored.join(names, "name", "left_semi").join(known.select("name"), "name", "left_anti").select(
            "name", "n_files", "size", F.lit("stored").alias("origin"))
        zero = F.lit(0).cast("bigint")
        after = summed.join(known.unionByName(first), "name", "left").select(
            "name", (F.coalesce("n_files", zero) + F.col("_n")).cast("bigint").alias("n_files"),
            (F.coalesce("size", zero) + F.col("_size")).cast("bigint").alias("size"), F.coalesce("origin", F.lit("new")).alias("origin"))
        tables.append_rows(after, root, "totals", version, tables.bucket("name"))

    return _started(deltas, apply, root, "totals", checkpoint, first_version, once, interval)


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    """The newest totals of every entity that a delta has named."""
    return tables.read_live(spark, root, "totals", TOTALS, "name")


def track_reports(events: DataFrame, root: str, checkpoint: str, first_version: int = 0, once: bool = True,
                  interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Whether each report path exists, kept below ``root``: a micro-batch writes the paths it names.

    The last event per path decides, also where micro-batches bring events late; it is taken map-side.
    """
    gone = F.col("event_type").isin("deleted", "moved")
    parts = F.array_compact(F.array(
        F.struct(F.col("src_path").alias("filepath"), (~gone).alias("present")),
        F.when((F.col("event_type") == "moved") & F.col("dest_path").isNotNull(),
               F.struct(F.col("dest_path").alias("filepath"), F.lit(True).alias("present")))))

    def apply(spark, batch, version):
        rows = batch.select("ts", F.inline(parts)).filter("filepath is not null").select("filepath", "ts", "present")
        known = _known(spark, root, "reports", PRESENT, "filepath", version - 1, rows)
        last = rows.unionByName(known).groupBy("filepath").agg(F.max(F.struct("ts", "present")).alias("l"))
        tables.append_rows(last.select("filepath", "l.*"), root, "reports", version, tables.bucket("filepath"))

    return _started(events, apply, root, "reports", checkpoint, first_version, once, interval)


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """The report files that exist."""
    return tables.read_live(spark, root, "reports", PRESENT, "filepath").filter("present").select("filepath")
