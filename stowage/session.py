"""Sessions, and the shared folder for data that has to outlive executors."""

import contextvars
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Of what is written: fingerprints are hexadecimal digits, which need a codec that counts them.
COMPRESSION = "zstd"
_local_folder = []


class NoSharedFolder(RuntimeError):
    """The session names no folder that all executors share."""


def local_session(cores: int | str = 8, partitions: int = 8, name: str = "stowage") -> SparkSession:
    """A session for tests and benchmarks on one machine; on a cluster use the one you are given.

    Times are taken as UTC throughout, and session windows merge before the shuffle.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        # Building a plan is several times faster without a Python stack trace per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.

    Where the setting is absent there is no such folder, and that is an error; only in a session of one process, as
    in tests, does a folder of that machine take its place.
    """
    return _folder(spark.conf.get(CHECKPOINT_KEY, None), spark.sparkContext.master)


def _folder(named, master):
    if named:
        return named
    if master != "local" and not master.startswith("local["):
        raise NoSharedFolder(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="stowage-"))
    return _local_folder[0]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: What the innermost block of ``intermediates`` of this thread has written.
_collecting = contextvars.ContextVar("stowage_intermediates", default=None)


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once and read back: cuts the lineage with files that survive the loss of executors."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path, compression=COMPRESSION)
    if (folders := _collecting.get()) is not None:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


class intermediates:
    """Deletes what was ``written`` inside the block when it ends: for passes whose results are stored elsewhere.

    A block has what its own thread writes in it and in no block within it, so that passes may run at once or in each other.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def __enter__(self):
        self.outer = _collecting.set(self.folders)

    def __exit__(self, *_):
        _collecting.reset(self.outer)
        for folder in self.folders:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fixed(spark: SparkSession, now: Column) -> Column:
    """The time that an expression has now, as a literal: a pass has one clock, however many jobs it takes."""
    # Over no table, so that it is no job.
    micros = spark.sql("SELECT 1").select(F.unix_micros(now.cast("timestamp"))).first()[0]
    return F.timestamp_micros(F.lit(micros))
