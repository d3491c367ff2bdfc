"""Finding the report file that belongs to a batch."""

from pyspark.sql import DataFrame, functions as F

from ..functions.paths import REPORT_TYPES, file_name, report_type


def find_reports(inventory: DataFrame) -> DataFrame:
    """Text files whose name holds a known report kind."""
    kind = report_type(file_name(F.col("filepath")))
    return inventory.select("filepath", kind.alias("report_type")).filter("report_type is not null")


def batch_reports(batches: DataFrame, reports: DataFrame, name: str = "batch") -> DataFrame:
    """For each batch and report kind the first report whose name contains the batch name.

    Containment is turned into equality: a report name is cut into all its substrings of the lengths
    batch names have, the smallest path per substring is taken map-side, and batches look themselves up by
    an equi-join. Lengths are those that occur, and end at the longest report name.
    """
    lengths = batches.select(F.length(name).alias("_length")).filter("_length > 0").distinct()
    text = file_name(F.col("filepath"))
    sized = reports.withColumn("_text", text).withColumn(
        "_length", F.explode(F.sequence(F.lit(1), F.greatest(F.length("_text"), F.lit(1)))))
    cut = sized.join(lengths, "_length").withColumn(
        "_from", F.explode(F.sequence(F.lit(1), F.length("_text") - F.col("_length") + 1)))
    pieces = cut.select(
        F.substring(F.col("_text"), F.col("_from"), F.col("_length")).alias(name),
        "report_type", "filepath")
    # Most pieces name no batch; they are left out before they are sorted for the aggregate.
    first = pieces.join(batches.select(name).distinct(), name, "left_semi").groupBy(name).agg(*[
        F.min(F.when(F.col("report_type") == kind, F.col("filepath"))).alias(kind)
        for kind in REPORT_TYPES])
    return batches.join(first, name, "left")
