"""Exact duplicates by a stream that keeps, on disk and for good, one entry for every digest it has met."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import run_dir
from .common import forget, forget_folder, stored

#: Files that one micro-batch takes at most.
FILES = 10_000
#: Repeated digests up to this number go to all tasks (some 150 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null is empty."""
    text = F.coalesce(text, F.lit(""))
    # Of a text that is ASCII throughout, plain lower case changes nothing else either, and is far faster.
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(rows: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """The normalised text of each row, its digest, its identifier and where its content lies: file and row."""
    own = rows.select(F.col(key).alias("id"), normalised(F.col(text)).alias("text"),
                      F.struct("_metadata.file_path", "_metadata.row_index").alias("place"))
    return own.select("id", "text", digest(F.col("text")).alias("digest"), "place")


def _source_schema(spark: SparkSession, source: str, key: str, text: str) -> T.StructType:
    found = spark.read.parquet(source).schema
    return T.StructType([found[key], found[text]])


def _as_pattern(spark: SparkSession, source: str) -> str:
    """A stream takes a folder, or a pattern: a single file is given as one that only it meets."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    single = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    return f"{source[:-1]}[{source[-1]}]" if single else source


def absorb(spark: SparkSession, source: str, state: str, key: str = "doc_id", text: str = "text", files: int = FILES,
           digest: Callable[[Column], Column] = sha256) -> None:
    """Take all files of a Parquet folder (or the one file) that are not yet taken into the keyed state below ``state``.

    The state is a streaming aggregate held in RocksDB and never expires. For each digest it has the greatest identifier
    that was met, the file and row where that row's content lies, and the number of rows. A later call takes the
    files that came since; one that was interrupted goes on where it stopped. ``state`` must be a shared folder.
    """
    session = spark.newSession()  # whose settings are those of this stream alone
    for name, value in (("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
                        ("spark.sql.streaming.stateStore.providerClass", _PROVIDER),
                        ("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true"),
                        # Else every partition of the state sets megabytes of disk aside, however small it is.
                        ("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")):
        session.conf.set(name, value)
    stream = session.readStream.schema(_source_schema(spark, source, key, text)).option("maxFilesPerTrigger", files).parquet(
        _as_pattern(spark, source))
    met = _located(stream, key, text, digest).groupBy("digest").agg(
        F.max(F.struct("id", "place")).alias("stays"), F.count(F.lit(1)).alias("rows"))
    query = met.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def entries(spark: SparkSession, state: str) -> DataFrame | None:
    """What the state holds: ``digest``, ``stays`` (identifier and place), ``rows``. None before anything was taken."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{state.rstrip('/')}/commits")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    kept = spark.read.format("statestore").load(state)
    stays, rows = kept.schema["value"].dataType.names
    return kept.select(F.col("key.digest").alias("digest"), F.col(f"value.`{stays}`").alias("stays"), F.col(f"value.`{rows}`").alias("rows"))


def _unlike(rows: DataFrame, held: DataFrame, broadcast_rows: int) -> DataFrame:
    """Digests of hits whose bytes are not those at the place that the state names for them: ``digest``, stored.

    Only rows whose digest was met more than once are looked at. The bytes to compare with are read at their place, one row a
    digest, so a text that any share of the rows has is a skewed join that can be split.
    """
    hits = held.filter("rows > 1").select("digest", F.col("stays.place").alias("at"))
    few = hits.limit(broadcast_rows + 1).count() <= broadcast_rows
    members = rows.join(F.broadcast(hits) if few else hits, "digest")
    first = members.filter(F.col("place") == F.col("at")).select("digest", F.col("text").alias("_held"))
    others = members.filter(F.col("place") != F.col("at")).select("digest", "text")
    return stored(others.join(first, "digest").filter(F.col("text") != F.col("_held")).select("digest"), "unlike-bytes")


def decisions(spark: SparkSession, source: str, state: str, key: str = "doc_id", text: str = "text",
              broadcast_rows: int = BROADCAST_ROWS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``key``, ``keep_id``, ``group_size``, ``kept`` and ``digest`` of every row of a folder that the state has taken.

    Of rows whose texts are equal but for the case of A-Z, null counting as empty, the one with the greatest identifier stays; null
    comes before all, and of rows equal in identifier too the one at the last place stays. ``keep_id`` is null
    only if all identifiers of the group are. Whole texts are compared byte by byte with the row that stays; of
    texts that share a digest and are not equal, each has a group of its own. Other columns are not read, whatever their names; an empty folder
    gives no rows. Stored intermediates are deleted, but the state stays.
    """
    own = _source_schema(spark, source, key, text)
    rows = _located(spark.read.schema(own).parquet(source), key, text, digest)
    found = entries(spark, state)
    columns = [F.col("id").alias(key), F.col("stays.id").alias("keep_id"), F.col("rows").alias("group_size"),
               (F.col("place") == F.col("stays.place")).alias("kept"), "digest"]
    if found is None:
        none = F.lit(None).cast(T.StructType([T.StructField("id", own[key].dataType), T.StructField("place", rows.schema["place"].dataType)]))
        return rows.filter("false").select("*", none.alias("stays"), F.lit(0).cast("long").alias("rows")).select(*columns)
    held = stored(found, "digests")
    unlike = _unlike(rows, held, broadcast_rows)
    decided = rows.drop("text").join(held, "digest")
    if not unlike.isEmpty():  # two texts of one digest: of these few digests, group by the texts
        shared = unlike.distinct()
        apart = rows.join(shared, "digest", "left_semi")
        groups = apart.groupBy("digest", "text").agg(F.max(F.struct("id", "place")).alias("stays"), F.count(F.lit(1)).alias("rows"))
        decided = decided.join(shared, "digest", "left_anti").unionByName(apart.join(groups, ["digest", "text"]).drop("text"))
    result = stored(decided.select(*columns), "exact-dedup")
    forget(held)
    forget(unlike)
    return result


def deduplicated(spark: SparkSession, source: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``decisions`` over a whole folder, with a state of its own that is deleted afterwards."""
    state = run_dir(spark, "digest-state")
    absorb(spark, source, state, key, text, **{k: v for k, v in options.items() if k in ("files", "digest")})
    result = decisions(spark, source, state, key, text, **{k: v for k, v in options.items() if k != "files"})
    forget_folder(spark, state)
    return result
