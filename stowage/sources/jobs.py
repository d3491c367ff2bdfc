"""Reading what the cluster says about its jobs; what cannot be read is set aside with the reason, in rows of its own."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.paths import clean_path
from ..operators.jobs import normalise_jobs
from ..schemas import JOB_SNAPSHOT

#: Of damaged text so much is kept.
SHOWN = 200


def _documents(spark, path):
    schema = T.StructType([*JOB_SNAPSHOT.fields, T.StructField("_damaged", T.StringType())])
    return spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_damaged").json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job listings as JSON documents ``{"jobs": [...]}``, one document per file; damaged documents are left out whole."""
    whole = _documents(spark, path).filter("_damaged is null")
    return normalise_jobs(whole.select(F.inline("jobs")))


def damaged_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Documents that ``read_jobs`` leaves out: ``filepath``, ``reason``, the beginning of the ``text``."""
    # Spark reads the text of damaged documents only along with another column.
    kept = _documents(spark, path).select("_damaged", "_metadata.file_path", F.coalesce(F.size("jobs"), F.lit(0)).alias("n"))
    return kept.filter("_damaged is not null and n >= 0").select(clean_path(F.col("file_path")).alias("filepath"), F.lit("no job listing").alias("reason"),
                       F.substring("_damaged", 1, SHOWN).alias("text"))


def _accounting(spark, path):
    """Lines of accounting text but for headers and blank ones; ``good`` have a job's number and a state."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"), parts.alias("p")).select(
        "value", "file_path", F.try_element_at("p", F.lit(1)).alias("job_id"), F.try_element_at("p", F.lit(2)).alias("state"),
        F.try_element_at("p", F.lit(3)).alias("exit_code"))
    lines = rows.filter((F.col("job_id") != "") & (F.col("job_id") != "JobID") & ~F.col("job_id").startswith("---"))
    return lines.withColumn("good", F.col("job_id").rlike("^[0-9]") & F.col("state").isNotNull())


def read_accounting(spark: SparkSession, path: str) -> DataFrame:
    """Accounting text, whitespace separated under one header line: job_id, state, exit_code; damaged lines are left out."""
    return _accounting(spark, path).filter("good").select("job_id", "state", "exit_code")


def damaged_accounting(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``read_accounting`` leaves out: ``filepath``, ``reason``, ``text``."""
    return _accounting(spark, path).filter("not good").select(
        clean_path(F.col("file_path")).alias("filepath"), F.when(F.col("state").isNull(), "no state").otherwise("no job number").alias("reason"),
        F.substring("value", 1, SHOWN).alias("text"))


def job_record(accounting: DataFrame, job_id: str) -> DataFrame:
    return accounting.filter(F.col("job_id") == job_id)


def _first_lines(spark, path):
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("filepath"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    first = lines.groupBy("filepath").agg(F.min_by("value", "at").alias("line"))
    return first.select(clean_path(F.col("filepath")).alias("filepath"), "line", F.trim("line").try_cast("int").alias("exit_code"))


def read_exit_codes(spark: SparkSession, path: str) -> DataFrame:
    """(filepath, exit_code) from the first line of each file; null where it is no number.

    Lines are streamed, so a file that turns out large is no problem: the first one is picked by
    its position.
    """
    return _first_lines(spark, path).select("filepath", "exit_code")


def damaged_exit_codes(spark: SparkSession, path: str) -> DataFrame:
    """Files whose first line is no number: ``filepath``, ``reason``, ``text``."""
    return _first_lines(spark, path).filter("exit_code is null").select(
        "filepath", F.lit("no exit code").alias("reason"), F.substring("line", 1, SHOWN).alias("text"))
