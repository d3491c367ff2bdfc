"""Expected outputs against what is on disk."""

from pyspark.sql import DataFrame, functions as F

from ..functions.documents import explode_two_levels
from ..functions.paths import file_name
from ..functions.predicates import matches_mask_column, matching_masks

SLOT = ["task_id", "group", "type"]


def expected_rows(tasks: DataFrame, column: str = "expected_output_data") -> DataFrame:
    """``{group: {type: mask}}`` documents as rows (task_id, group, type, mask)."""
    return explode_two_levels(tasks.select("task_id", column), column, "group", "type", "mask")


def usable(listing: DataFrame) -> DataFrame:
    """Regular files that are not empty."""
    return listing.filter(F.col("is_file") & (F.col("size") > 0))


def match_outputs(expected: DataFrame, listing: DataFrame, masks: list[str] | None = None) -> DataFrame:
    """Found files as rows (task_id, group, type, filepath, size).

    With ``masks``, the distinct masks of the configuration, every file is tested once against
    compiled literal patterns and only its hits go on, as keys of a plain equi-join. Without, the
    mask comes from the row: the join is on the task and the pattern is a residual test. What is found goes on by
    slot, an exchange that lets adaptive execution split a task with very many files.
    """
    files = usable(listing).select("task_id", "filepath", "size")
    name = file_name(F.col("filepath"))
    if masks is not None:
        hits = files.withColumn("mask", F.explode(matching_masks(name, masks)))
        return hits.join(expected, ["task_id", "mask"]).select(*SLOT, "filepath", "size")
    joined = files.join(expected, "task_id").filter(matches_mask_column(name, F.col("mask")))
    return joined.select(*SLOT, "filepath", "size").repartition(*SLOT)


def output_totals(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Files and bytes per expected slot, zero where nothing matched.

    Found files are summed map-side first, so the outer join meets one row per slot.
    """
    totals = found.groupBy(*SLOT).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size"))
    zero = F.lit(0).cast("bigint")
    return expected.join(totals, SLOT, "left").select(
        *SLOT, "mask", F.coalesce("n_files", zero).alias("n_files"), F.coalesce("size", zero).alias("size"))


def task_output_size(totals: DataFrame) -> DataFrame:
    return totals.groupBy("task_id").agg(
        F.sum("size").alias("output_files_size"), F.sum("n_files").alias("n_files"),
        F.sum(F.when(F.col("n_files") == 0, 1).otherwise(0)).alias("n_missing"))


def missing_outputs(totals: DataFrame) -> DataFrame:
    return totals.filter("n_files = 0").select(*SLOT, "mask")


def overlay(found: DataFrame, shaped: DataFrame, value: str = "value") -> DataFrame:
    """Shaper outputs over found ones per (task, group, type): the shaper's value wins."""
    new = shaped.select(*SLOT, F.col(value).alias("_new"), F.lit(True).alias("_shaped"))
    joined = found.select(*SLOT, value).join(new, SLOT, "full_outer")
    return joined.select(*SLOT, F.when(F.col("_shaped").isNotNull(), F.col("_new")).otherwise(
        F.col(value)).alias(value))


def rerun_list(tasks: DataFrame, totals: DataFrame) -> DataFrame:
    """Failed tasks, and finished ones that lack an expected output, with the number missing."""
    missing = totals.filter("n_files = 0").groupBy("task_id").agg(F.count(F.lit(1)).alias("n_missing"))
    joined = tasks.join(missing, "task_id", "left").withColumn(
        "n_missing", F.coalesce("n_missing", F.lit(0).cast("bigint")))
    return joined.filter((F.col("status") == "failed")
                         | ((F.col("status") == "completed") & (F.col("n_missing") > 0)))
