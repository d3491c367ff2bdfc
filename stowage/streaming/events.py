"""Event streams: reading, debouncing, and applying them to a stored catalog."""

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import batch_name
from ..plans.indexing import committed, sync_events
from ..schemas import FILE_EVENTS
from ..session import intermediates, written

# The default waiting times.
FILE_DEBOUNCE = "5 seconds"
WRITE_DEBOUNCE = "10 seconds"
FLUSH_INTERVAL = "30 seconds"
BATCH_HOLD = "10 minutes"
#: What waits may be most of a catalog: it is kept in RocksDB on the executors' disks, not in their heaps. A stream that was begun otherwise goes on so.
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Else every partition of the state sets megabytes of disk aside, however small it is.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def read_events(spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType = FILE_EVENTS,
                **options) -> DataFrame:
    """File events as they are dropped into a folder."""
    return spark.readStream.schema(schema).options(**options).format(format).load(path)


def debounce(events: DataFrame, keys, ts: str = "ts", gap: str = FILE_DEBOUNCE, watermark: str = "0 seconds",
             payload=(), tie=()) -> DataFrame:
    """One row per burst of a key: its last event, once the gap has passed without another.

    Rows: the keys, ``session_start``, ``settled_at`` (the last event's time), ``n_events`` and the last
    event's payload. An event exactly one gap after another still belongs to its burst. The session should set
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``, so that a busy key sends its bursts
    and not its events through the shuffle.
    """
    last = F.max_by(F.struct(F.col(ts).alias("at"), *payload), F.struct(ts, *tie)).alias("_last")
    bursts = events.withWatermark(ts, watermark).groupBy(*keys, F.session_window(ts, gap)).agg(
        last, F.count(F.lit(1)).alias("n_events"))
    return bursts.select(
        *keys, F.col("session_window.start").alias("session_start"), F.col("_last.at").alias("settled_at"),
        "n_events", *[F.col(f"_last.{p}").alias(p) for p in payload])


_STAT = ("size", "ctime", "mtime", "dev", "ino", "nlink", "is_dir")
_PACKED = "size long, ctime long, mtime long, dev long, ino long, nlink long, is_dir boolean"


def _packed() -> Column:
    """An event's stat fields as one text, null where it brought none."""
    fields = [F.unix_micros(c).alias(c) if c in ("ctime", "mtime") else F.col(c) for c in _STAT]
    return F.when(F.col("size").isNotNull(), F.to_json(F.struct(*fields)))


def _modifications(rows: DataFrame, ts: str) -> DataFrame:
    """Rows (src_path, at, stat) as file events."""
    stat = rows.withColumn("stat", F.from_json("stat", _PACKED))
    return stat.select(
        F.lit("modified").alias("event_type"), "src_path", F.lit(None).cast("string").alias("dest_path"), F.timestamp_micros("at").alias(ts),
        *[(F.timestamp_micros(f"stat.{c}") if c in ("ctime", "mtime") else F.col(f"stat.{c}")).alias(c) for c in _STAT])


#: Events that are held before those of each path are folded.
_MOST = 20_000
#: Parts that waiting paths are dealt to: Python is called once for a part and not for each path. Fixed for the life of a checkpoint.
PARTS = 4096
_WAITING = "paths array<string>, ats array<long>, stats array<string>, dues array<long>"


def _folded(rows: list[tuple]) -> list[tuple]:
    """Of modifications and losses of a path (time, whether a loss, stat), in order: the losses, and between them the last
    modification and the last that brought content. Folding again with more rows is the same as folding once."""
    kept, last, full = [], None, None

    def close():
        kept.extend(x for x in ((full, last) if full is not last else (last,)) if x)

    for row in sorted(rows, key=lambda r: r[:2]):
        if row[1]:
            close()
            kept.append(row)
            last = full = None
        else:
            last, full = row, row if row[2] is not None else full
    close()
    return kept


def _waiting(milliseconds: int):
    """Keeps the last modification of each path of a part until no other has come for so long, or until the path is lost."""
    import pandas as pd

    def step(key, frames, state):
        now = state.getCurrentProcessingTimeMs()
        waiting = {path: rest for path, *rest in zip(*state.get)} if state.exists else {}
        rows, held, most = {}, 0, _MOST
        for frame in frames:
            stats = (s if isinstance(s, str) else None for s in frame["stat"].tolist())
            for path, *row in zip(frame["src_path"].tolist(), frame["at"].tolist(), frame["loss"].tolist(), stats):
                rows.setdefault(path, []).append(tuple(row))
            held += len(frame)
            if held > most:  # a path may have any number of events
                rows = {path: _folded(found) for path, found in rows.items()}
                held = sum(map(len, rows.values()))
                most = max(_MOST, 2 * held)
        due = []
        for path, found in rows.items():
            if path in waiting:
                at, stat, _ = waiting.pop(path)
                found = [(at, False, stat), *found]
            last = None
            for at, loss, stat in _folded(found):
                if loss and last:
                    due.append((path, *last))
                last = None if loss else (at, stat if stat is not None else last and last[1])
            if last:
                waiting[path] = (*last, now + milliseconds)
        for path in [path for path, (_, _, when) in waiting.items() if when <= now]:  # never one that was named just now
            at, stat, _ = waiting.pop(path)
            due.append((path, at, stat))
        if waiting:
            state.update(tuple(map(list, zip(*((path, *rest) for path, rest in waiting.items())))))
            state.setTimeoutDuration(max(1, min(when for _, _, when in waiting.values()) - now))
        elif state.exists:
            state.remove()
        if due:
            yield pd.DataFrame(due, columns=["src_path", "at", "stat"])

    return step


def quiet_events(events: DataFrame, ts: str = "ts", gap: str = WRITE_DEBOUNCE) -> DataFrame:
    """File events in front of the catalog: modifications once their path is quiet, everything else at once.

    A modification waits until ``gap`` of the clock has passed without another of its path; then one event goes on, with the
    last time and the newest stat fields. A path that is moved or deleted has its waiting modification go on
    before that, in the same micro-batch, so that no content is lost on the way and no lost path comes back. What
    still waits when the stream stops is in its state: it goes on after a restart, or see ``open_modifications``.
    Modifications without a path or a time do not wait.
    """
    seconds = F.expr(f"INTERVAL {gap}")
    milliseconds = int(events.sparkSession.sql("SELECT 1").select(
        (F.unix_micros(F.timestamp_micros(F.lit(0)) + seconds) / 1000).cast("bigint")).first()[0])
    modified = F.coalesce((F.col("event_type") == "modified") & F.col("src_path").isNotNull() & F.col(ts).isNotNull(), F.lit(False))
    lost = F.coalesce(F.col("event_type").isin("moved", "deleted") & F.col("src_path").isNotNull() & F.col(ts).isNotNull(), F.lit(False))
    watched = events.filter(modified | lost).select(
        "src_path", F.unix_micros(ts).alias("at"), lost.alias("loss"), F.when(~lost, _packed()).alias("stat"))
    due = watched.withColumn("part", F.pmod(F.xxhash64("src_path"), F.lit(PARTS)).cast("int")).groupBy("part").applyInPandasWithState(
        _waiting(milliseconds), "src_path string, at long, stat string", _WAITING, "append", "ProcessingTimeTimeout")
    at_once = events.filter(~modified)
    return at_once.unionByName(_modifications(due, ts).select(*events.columns))


def open_modifications(spark: SparkSession, checkpoint: str, ts: str = "ts") -> DataFrame:
    """The modifications that a stopped stream of ``quiet_events`` still holds, as events; its state stays as it is."""
    state = spark.read.format("statestore").load(checkpoint).select("value.groupState.*").filter("paths is not null")
    rows = state.select(F.inline(F.arrays_zip("paths", "ats", "stats"))).toDF("src_path", "at", "stat")
    return _modifications(rows, ts)


def hold_batches(events: DataFrame, ts: str = "ts", hold: str = BATCH_HOLD, watermark: str = "0 seconds") -> DataFrame:
    """Batches released after the hold time without a change."""
    named = events.withColumn("batch", batch_name(F.col("src_path")))
    return debounce(named, ["batch"], ts, hold, watermark)


def due_writes(changes: DataFrame, target: str = "target", ts: str = "ts", gap: str = WRITE_DEBOUNCE,
               watermark: str = "0 seconds") -> DataFrame:
    """Targets whose buffered changes are due: no change came for the write debounce."""
    return debounce(changes, [target], ts, gap, watermark)


def open_bursts(spark: SparkSession, checkpoint: str, keys, payload=()) -> DataFrame:
    """The bursts a stopped ``debounce`` stream still holds open, in the shape of its rows.

    Used on shutdown. They are read from the stream's state, which stays as it is: after a restart a burst
    goes on where it was, and is due when its gap has passed.
    """
    state = spark.read.format("statestore").load(checkpoint).select("value.*")
    # Columns follow the query's: the keys, the window, the last event with its order, the count.
    names = state.columns
    last = names[names.index("session_window") + 1]
    return state.select(
        *keys, F.col("session_window.start").alias("session_start"), F.col(f"{last}.at").alias("settled_at"),
        F.col("count").alias("n_events"), *[F.col(f"{last}.{p}").alias(p) for p in payload])


def start(df: DataFrame, path: str, checkpoint: str, once: bool = True, interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Append a stream's rows to a folder: all that is there and stop, or every interval."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def sync_catalog(events: DataFrame, root: str, link_dir: str, now: Column, checkpoint: str, first_version: int,
                 once: bool = True, interval: str = FLUSH_INTERVAL,
                 reports: Callable[[SparkSession], DataFrame] | None = None, **options) -> StreamingQuery:
    """Keep a stored catalog up to date with a stream of file events.

    To have modifications wait until a file is no longer written, give it ``quiet_events``. ``reports`` gives the report files
    that exist as of each micro-batch, such as ``state.read_reports`` of a stream of their events; ``options`` go to each pass.

    Micro-batch ``n`` is pass ``first_version + n``; one that was already finished before a restart is
    skipped, one that was interrupted is written again. Deletions, additions, moves, batches and
    samples are written by the pass in that order of dependence.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, first_version + batch_id
        if version > committed(spark, root):
            known = {} if reports is None else {"reports": reports(spark)}
            with intermediates(spark):
                # A batch is read more than once, and each time would have its keyed state worked out again.
                sync_events(spark, root, written(batch, "batch"), link_dir, now, version, **known, **options)

    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if not once:
        with _set(events.sparkSession, _ON_DISK):
            return writer.trigger(processingTime=interval).start()
    # A stream that keeps state by the clock would else go on with empty batches and never stop.
    with _set(events.sparkSession, _ON_DISK | {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
        return writer.trigger(availableNow=True).start()


@contextlib.contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    """A stream that is started inside keeps these settings; those of the session are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
