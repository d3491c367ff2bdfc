"""Choosing work: which samples a processing rule accepts, what is ready, what gets a slot."""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.durations import priority_ratio
from ..functions.paths import file_name, task_id
from ..functions.predicates import (
    all_of, any_of, compile_conditions, compile_requirements, lacks_key, matches_mask,
    requirement_path,
)

# The two admission orders and the states that occupy a slot.
SHORTEST_FIRST, LONGEST_FIRST = "SJF", "LJF"
IN_QUEUE = ("queued", "processing")
# A queue's prepared tasks are ranked in so many parts first; it may hold any share of all tasks.
RANK_PARTS = 64


def candidates(samples: DataFrame, rules: list[dict], tasks: DataFrame | None = None) -> DataFrame:
    """(sample_id, pipeline_id) for each rule an indexed sample meets and has not been given yet.

    Rules are configuration, so all of them are evaluated in one scan of the samples. ``tasks``
    additionally excludes pairs that the task table knows.
    """
    def accepted(rule):
        test = (compile_conditions(rule.get("conditions", []), samples.schema)
                & lacks_key(F.col("tasks"), rule["pipeline_id"]))
        return F.when(test, F.lit(rule["pipeline_id"]))

    indexed = samples.filter(F.col("status") == "indexed")
    hits = F.array_compact(F.array(*[accepted(r) for r in rules]))
    found = indexed.select("sample_id", F.explode(hits).alias("pipeline_id"))
    if tasks is not None:
        found = found.join(tasks.select("sample_id", "pipeline_id"), ["sample_id", "pipeline_id"], "left_anti")
    return found


def new_tasks(found: DataFrame, samples: DataFrame, results: DataFrame, rules: DataFrame, now) -> DataFrame:
    """Tasks for candidates whose sample and result documents both exist."""
    complete = with_documents(found, samples, results)
    known = rules.select("pipeline_id", "sorting", "timeout", F.col("name").alias("pipeline_name"),
                         F.col("version").alias("pipeline_version"))
    return complete.join(known, "pipeline_id").withColumns({
        "task_id": task_id(F.col("sample_id"), F.col("pipeline_id")),
        "status": F.lit("created"), "created": now, "last_update": now,
    })


def with_documents(found: DataFrame, samples: DataFrame, results: DataFrame) -> DataFrame:
    return (found.join(samples.select("sample_id"), "sample_id", "left_semi")
            .join(results.select("sample_id"), "sample_id", "left_semi"))


def without_documents(found: DataFrame, samples: DataFrame, results: DataFrame) -> DataFrame:
    """Candidates that cannot become tasks, with what they lack."""
    def flag(df, name):
        return df.select("sample_id").distinct().withColumn(name, F.lit(True))

    joined = found.join(flag(samples, "_sample"), "sample_id", "left").join(
        flag(results, "_result"), "sample_id", "left")
    lacking = F.array_compact(F.array(
        F.when(F.col("_sample").isNull(), "sample"), F.when(F.col("_result").isNull(), "result")))
    return joined.withColumn("lacking", lacking).drop("_sample", "_result").filter(F.size("lacking") > 0)


def input_groups(files: DataFrame, groups: dict[str, list[dict]], source: str = "sample",
                 attributes: str | None = None) -> DataFrame:
    """Long rows (…, group, path, size): the files each input group takes from one kind of source.

    A group takes the union of its masks; a file meeting several masks of a group is in it once.
    For results the specification's ``attributes`` path picks which output the file belongs to.
    """
    def takes(spec):
        return all_of([
            any_of([matches_mask(file_name(F.col("filepath")), m) for m in spec["file_mask"]]),
            compile_requirements(spec.get("requirements")),
            F.lit(True) if attributes is None or not spec.get("attributes")
            else F.col(attributes) == spec["attributes"],
        ])

    entries = [
        F.when(takes(spec), F.struct(F.lit(group).alias("group"),
                                     requirement_path(spec.get("requirements")).alias("path")))
        for group, specs in groups.items() for spec in specs if spec["source"] == source
    ]
    hits = F.array_distinct(F.array_compact(F.array(*entries)))
    return files.withColumn("_hit", F.explode(hits)).select(
        *files.columns, "_hit.group", "_hit.path")


def input_totals(grouped: DataFrame, keys=("task_id", "group")) -> DataFrame:
    """Files and bytes per task and group (or per task)."""
    return grouped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size"))


def group_readiness(tasks: DataFrame, totals: DataFrame, groups: dict[str, list[dict]]) -> DataFrame:
    """Which required and preferred groups each task lacks; it is ready when no required one."""
    def strictest(specs):
        return "required" if any(s["condition"] == "required" for s in specs) else "preferred"

    conditions = {g: strictest(specs) for g, specs in groups.items()}
    present = totals.groupBy("task_id").agg(*[
        F.max(F.when(F.col("group") == g, F.col("n_files"))).alias(f"_g{i}")
        for i, g in enumerate(conditions)])

    def lacking(condition):
        return F.array_compact(F.array(*[
            F.when(F.coalesce(f"_g{i}", F.lit(0)) == 0, F.lit(g))
            for i, (g, c) in enumerate(conditions.items()) if c == condition]).cast("array<string>"))

    joined = tasks.join(present, "task_id", "left")
    return joined.select(
        *tasks.columns, lacking("required").alias("missing_required"),
        lacking("preferred").alias("missing_preferred"),
    ).withColumn("ready", F.size("missing_required") == 0)


def validate(prepared: DataFrame) -> DataFrame:
    """Check the shaped input of each task: prepared when complete, else disprepared with reasons.

    Needs ``command, n_groups, input_files_size, n_expected``.
    """
    reasons = F.array_compact(F.array(
        F.when(F.coalesce("command", F.lit("")) == "", "no command"),
        F.when(F.coalesce("n_groups", F.lit(0)) == 0, "no input groups"),
        F.when(F.coalesce("input_files_size", F.lit(0)) <= 0, "no input bytes"),
        F.when(F.coalesce("n_expected", F.lit(0)) == 0, "no expected outputs"),
    ))
    checked = prepared.withColumn("reasons", reasons)
    return checked.withColumn(
        "status", F.when(F.size("reasons") == 0, "prepared").otherwise("disprepared"))


def queue_usage(tasks: DataFrame) -> DataFrame:
    """How many tasks of each queue hold a slot."""
    return tasks.filter(F.col("status").isin(*IN_QUEUE)).groupBy("sorting").agg(
        F.count(F.lit(1)).alias("in_use"))


def free_slots(tasks: DataFrame, capacity: dict[str, int]) -> DataFrame:
    """One row per configured queue: ``capacity``, ``in_use`` and the ``slots`` left."""
    spark = tasks.sparkSession
    sizes = spark.createDataFrame(sorted(capacity.items()), "sorting string, capacity bigint")
    usage = queue_usage(tasks.filter(F.col("sorting").isin(*capacity)))
    in_use = F.coalesce("in_use", F.lit(0).cast("bigint"))
    return sizes.join(usage, "sorting", "left").select(
        "sorting", "capacity", in_use.alias("in_use"),
        F.greatest(F.col("capacity") - in_use, F.lit(0).cast("bigint")).alias("slots"))


def weighted(tasks: DataFrame) -> DataFrame:
    """Prepared tasks with their priority ratio and the position key of their queue's order."""
    ratio = priority_ratio(F.col("input_files_size"), F.col("timeout"))
    position = F.when(F.col("sorting") == LONGEST_FIRST, -F.col("ratio")).otherwise(F.col("ratio"))
    return tasks.filter(F.col("status") == "prepared").withColumn("ratio", ratio).withColumn(
        "position", position)


def first_per_queue(tasks: DataFrame, capacity: dict[str, int]) -> DataFrame:
    """At most a full queue's worth of prepared tasks per queue, best first, with their rank.

    Tasks are ranked within parts of a queue, and only the first of each part, as many as the queue holds, are ranked
    again by queue: at most ``RANK_PARTS`` times its capacity. The largest capacity is a literal bound as well, so that the
    planner limits every group before it is shuffled, and not only after.
    """
    ready = weighted(tasks).filter(F.col("sorting").isin(*capacity))
    order = [F.col("position").asc_nulls_last(), F.col("task_id")]
    sizes = F.create_map(*[F.lit(x) for pair in sorted(capacity.items()) for x in pair])
    part = F.pmod(F.xxhash64("task_id"), F.lit(RANK_PARTS))
    within_queue = (F.col("rank") <= max(capacity.values(), default=0)) & (F.col("rank") <= F.try_element_at(sizes, F.col("sorting")))
    within = F.row_number().over(Window.partitionBy("sorting", "_part").orderBy(*order))
    first = ready.withColumn("_part", part).withColumn("rank", within).filter(within_queue)
    rank = F.row_number().over(Window.partitionBy("sorting").orderBy(*order))
    return first.withColumn("rank", rank).filter(within_queue).drop("position", "_part")


def admit(tasks: DataFrame, capacity: dict[str, int]) -> DataFrame:
    """The prepared tasks that get a slot now: smallest ratio first in SJF, largest in LJF."""
    slots = free_slots(tasks, capacity).select("sorting", "slots")
    best = first_per_queue(tasks, capacity)
    # One row per configured queue, so the broadcast is as small as the configuration.
    return best.join(F.broadcast(slots), "sorting").filter(F.col("rank") <= F.col("slots")).drop("slots")
