"""The registered queries: each runs operators over whole tables of a data set.

Results are flattened to scalar columns: times as epoch microseconds, lists and maps joined to text.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import views as V
from .functions import documents, durations, fingerprints, paths, predicates, states, templates
from .operators import curation, diff, events, jobs, ordered, outputs, reports, rollup, shapers, versions, work
from .plans import curation as plan_curation, indexing, scheduling
from .schemas import SAMPLE_DEFAULTS, SAMPLES
from .session import run_dir, written
from .sources import jobs as job_source, listing, rules as rule_source, tables
from .streaming import events as event_stream, state as state_stream

QUERIES = {}
HOUR = 3600
FILES_A_TASK = 250
FLAGS = ["is_file", "is_dir", "is_symlink"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def us(column) -> F.Column:
    """A time as epoch microseconds."""
    return F.unix_micros((F.col(column) if isinstance(column, str) else column).cast("timestamp"))


def joined(column) -> F.Column:
    return F.array_join(column, ",")


def _now():
    return V.ts(V.NOW)


def _diff(spark, d):
    return diff.snapshot_diff(V.files_now(spark, d), V.catalog_active(spark, d))


def _pairs(spark, d):
    return rollup.membership(V.files_now(spark, d))


def _old_pairs(spark, d):
    return rollup.membership(V.catalog_active(spark, d))


# --- paths, fingerprints and other scalars -------------------------------------------------------

@query
def path_identity(spark, d):
    return V.files_now(spark, d).select(
        "filepath", "batch", "sample", "symlink", "name", "basename", "directory", "extension", "symlink_dir")


@query
def page_paths(spark, d):
    return V.table(spark, d, "pages").select("page_id", paths.clean_path(F.col("url")).alias("path"))


@query
def file_fingerprint(spark, d):
    return V.files_now(spark, d).select("filepath", "fingerprint")


@query
def sample_identity(spark, d):
    s = rollup.sample_rollup(_pairs(spark, d))
    return s.select(
        "sample", paths.sample_id(F.col("sample"), F.col("fingerprint")).alias("sample_id"),
        paths.entity_dir(F.lit("/proc"), F.col("sample"), F.col("fingerprint")).alias("processing_dir"),
        paths.entity_dir(F.lit("/res"), F.col("sample"), F.col("fingerprint")).alias("result_dir"))


def _tasks_with_rules(spark, d):
    rules = rule_source.load_rules(spark, V.RULES).select(
        "pipeline_id", F.col("name").alias("pipeline_name"), F.col("version").alias("pipeline_version"),
        F.col("timeout").alias("rule_timeout"), F.size("conditions").alias("n_conditions"))
    return V.tasks(spark, d).join(rules, "pipeline_id")


@query
def task_paths(spark, d):
    t = _tasks_with_rules(spark, d).withColumns({
        "processing_dir": F.concat(F.lit("/proc/"), F.col("sample_id")),
        "result_dir": F.concat(F.lit("/res/"), F.col("sample_id")),
        "task_id": F.concat_ws("_", "task_id", paths.task_id(F.col("sample_id"), F.col("pipeline_id"))),
    })
    return paths.task_dirs(t).select(
        "task_id", "work_dir", "task_result_dir", "log_dir", "head_job_stdout", "head_job_stderr",
        "head_job_exitcode_f")


@query
def rules_in_use(spark, d):
    return _tasks_with_rules(spark, d).groupBy("pipeline_id", "pipeline_version", "rule_timeout").agg(
        F.count(F.lit(1)).alias("n_tasks"), F.max("n_conditions").cast("bigint").alias("n_conditions"),
        F.max(durations.timeout_minutes(F.col("rule_timeout"))).alias("minutes"))


@query
def submitted_job_ids(spark, d):
    t = V.tasks(spark, d)
    number = F.col("job_id").cast("string")
    text = (
        F.when(F.col("status") == "failed", F.concat(F.lit("sbatch: note\n  Submitted batch job "), number, F.lit("\nbye")))
        .when(F.col("status") == "processing", F.concat(F.lit("Submitted batch job "), number, F.lit(" on cluster x")))
        .when(F.col("status") == "queued", F.concat(F.lit("Submitted batch job "), number))
        .otherwise("error: Submitted batch job x")
    )
    return t.select("task_id", states.submitted_job_id(text).alias("submitted"))


@query
def normalised_jobs(spark, d):
    return jobs.normalise_jobs(V.raw_jobs(spark, d)).select(
        "job_id", "name", "array_job_id", "parent_job_id", joined("nodes").alias("nodes"), "partition",
        "priority", "status", "stderr", "stdout", "exit_code", "work_dir", us("start").alias("start_us"),
        us("limit").alias("limit_us"))


# --- files with damage in them, written here and read -------------------------------------------------

def _job_documents(spark, d):
    """Job listings of some thousand numbers a document, every seventh cut short."""
    root, raw = run_dir(spark, "job-documents"), V.raw_jobs(spark, d)
    document = F.floor(F.col("job_id") / 5000)
    whole = raw.groupBy(document.alias("document")).agg(F.collect_list(F.struct(*raw.columns)).alias("jobs")).select(
        "document", F.to_json(F.struct("jobs")).alias("text"))
    cut = F.when(F.col("document") % 7 == 3, F.expr("left(text, length(text) - 9)")).otherwise(F.col("text"))
    whole.select("document", cut.alias("text")).repartition("document").write.partitionBy("document").text(root, compression="gzip")
    return root


@query
def read_job_documents(spark, d):
    return job_source.read_jobs(spark, _job_documents(spark, d)).select("job_id", "parent_job_id", "status", us("start").alias("start_us"))


@query
def damaged_job_documents(spark, d):
    found = job_source.damaged_jobs(spark, _job_documents(spark, d))
    return found.select(F.regexp_extract("filepath", "/document=([0-9]+)/", 1).cast("bigint").alias("document"), "reason",
                        F.substring("text", 1, 9).alias("begins"))


def _accounting_text(spark, d):
    """A line for each job under a header; some lines lack the state, some the number."""
    root, j = run_dir(spark, "accounting"), _jobs(spark, d)
    line = F.when(F.col("job_id") % 11 == 4, F.format_string(" %d", "job_id")).when(
        F.col("job_id") % 13 == 5, F.format_string("job%d %s", "job_id", "status")).otherwise(
        F.format_string("  %d   %s   0:0", "job_id", "status"))
    header = j.limit(1).select(F.explode(F.array(F.lit("  JobID   State ExitCode"), F.lit("-----  ----- ------"), F.lit(""))).alias("value"))
    header.unionByName(j.select(line.alias("value"))).write.text(root)
    return root


@query
def read_accounting_text(spark, d):
    return job_source.read_accounting(spark, _accounting_text(spark, d))


@query
def damaged_accounting_lines(spark, d):
    return job_source.damaged_accounting(spark, _accounting_text(spark, d)).select("reason", F.trim("text").alias("text"))


def _exit_code_files(spark, d):
    """A file for each supplier, with a code in its first line or something else."""
    root, s = run_dir(spark, "exit-codes"), V.table(spark, d, "supplier").select("s_suppkey")
    first = F.when(F.col("s_suppkey") % 9 == 5, "oops").otherwise((F.col("s_suppkey") % 256).cast("string"))
    lines = s.select("s_suppkey", F.posexplode(F.array(first, F.lit("7"))).alias("line", "value"))
    # Files are many and small: by their bytes one task would write them all, and the driver would move them one by one.
    parts = s.count() // FILES_A_TASK + 1
    lines.repartition(parts, "s_suppkey").sortWithinPartitions("s_suppkey", "line").drop("line").write.partitionBy("s_suppkey").option(
        "mapreduce.fileoutputcommitter.algorithm.version", 2).text(root)
    return root


def _supplier():
    return F.regexp_extract("filepath", "/s_suppkey=([0-9]+)/", 1).cast("bigint").alias("s_suppkey")


@query
def read_exit_code_files(spark, d):
    return job_source.read_exit_codes(spark, _exit_code_files(spark, d)).select(_supplier(), "exit_code")


@query
def damaged_exit_code_files(spark, d):
    return job_source.damaged_exit_codes(spark, _exit_code_files(spark, d)).select(_supplier(), "reason", "text")


@query
def command_lines(spark, d):
    template = V.RULES["polish_v0-3-1"]["command_template"]
    return V.tasks(spark, d).select("task_id", templates.render(template, {
        "SAMPLE": F.col("sample_id"), "RUN_ID": F.col("job_id"), "OUT": F.concat(F.lit("/res/$1/"), "sample_id"),
    }).alias("command"))


@query
def timeout_minutes(spark, d):
    return V.tasks(spark, d).select("task_id", "timeout", durations.timeout_minutes(F.col("timeout")).alias("minutes"))


@query
def priority_ratio(spark, d):
    ratio = durations.priority_ratio(F.col("input_files_size"), F.col("timeout"))
    return V.tasks(spark, d).select("task_id", ratio.alias("ratio"))


@query
def elapsed_hms(spark, d):
    return V.tasks(spark, d).select(
        "task_id", durations.elapsed(F.col("queued"), _now()).alias("in_processing"),
        durations.elapsed(F.col("created"), F.col("queued")).alias("waiting"),
        durations.elapsed(_now(), F.col("queued")).alias("backwards"),
        durations.hms(F.col("input_files_size") / 1e7).alias("short"))


@query
def earliest_latest(spark, d):
    t = V.tasks(spark, d).withColumn("seen", F.when(F.col("status") == "failed", _now()))
    return t.select(
        "task_id", us(durations.earliest(F.col("seen"), F.col("queued"))).alias("first_us"),
        us(durations.latest(F.col("created"), F.col("seen"))).alias("last_us"))


@query
def utc_times(spark, d):
    e = V.file_events(spark, d)
    zone = F.when(F.col("event_type") == "moved", "+03:00").when(F.col("event_type") == "deleted", "-05:30")
    return e.select("event_id", us(durations.to_utc(F.col("ts"), zone)).alias("utc_us"),
                    us(durations.epoch_to_utc(F.col("size"))).alias("epoch_us"))


@query
def exit_status(spark, d):
    c = V.exit_codes(spark, d)
    status = states.exit_status(F.col("exit_code"))
    return c.select("job_id", status.alias("job_status"), states.final_task_status(status).alias("task_status"),
                    states.live_task_status(status).alias("if_listed"))


@query
def map_edits(spark, d):
    s = V.samples(spark, d)
    put = documents.put_key(F.col("tasks"), F.lit("assemble_v5-0-0"), F.create_map(F.col("sample_id"), F.lit("queued")))
    again = documents.put_key(put, F.lit("polish_v0-3-1"), F.create_map(F.lit("t"), F.lit("failed")))
    dropped = documents.drop_key(F.col("tasks"), F.lit("polish_v0-3-1"))
    return s.select("sample_id", joined(F.array_sort(F.map_keys(put))).alias("put_keys"),
                    joined(F.map_values(again["polish_v0-3-1"])).alias("replaced"),
                    F.size(dropped).cast("bigint").alias("left"))


@query
def sample_documents(spark, d):
    """Rows to JSON documents and back, and dotted paths into the text."""
    s = V.samples(spark, d).withColumn("_private", F.lit("x"))
    text = documents.to_documents(s, "document")
    back = text.select(
        documents.nested_value(F.col("document"), "kit.name").alias("kit_name"),
        documents.nested_value(F.col("document"), "_private").alias("private"),
        F.from_json("document", V.samples(spark, d).schema).alias("doc"))
    return back.select("doc.sample_id", "doc.size", "kit_name", "private", joined("doc.batches").alias("batches"),
                       joined(F.map_keys("doc.tasks")).alias("task_rules"))


@query
def defaulted_samples(spark, d):
    """Stored documents read under the declared schema, with its defaults."""
    s = documents.fill_defaults(V.samples(spark, d), SAMPLES, SAMPLE_DEFAULTS)
    return s.select("sample_id", "name", "status", "processing_dir", "previous_version", "size",
                    F.size("files").cast("bigint").alias("n_files"), F.size("tasks").cast("bigint").alias("n_tasks"))


@query
def expected_rows(spark, d):
    return outputs.expected_rows(V.expected_outputs(spark, d))


# --- predicates ----------------------------------------------------------------------------------

@query
def active_files(spark, d):
    return V.catalog_active(spark, d).select("symlink", "size", "status")


@query
def catalog_find(spark, d):
    found = tables.find(
        V.catalog(spark, d),
        [{"field": "status", "type": "nin", "value": ["deprecated", "deleted"]},
         {"field": "size", "type": "gte", "value": 20_000_000}],
        include=["symlink", "size", "status"], exclude=["status"])
    return found


@query
def tasks_by_status(spark, d):
    return jobs.tasks_in(V.tasks(spark, d), ["prepared", "queued", "processing"]).select("task_id", "status")


@query
def find_one_file(spark, d):
    return tables.find_one(V.catalog_active(spark, d), "batch", "B7", order="symlink").select("symlink", "size")


@query
def tasks_not_exists(spark, d):
    return V.samples(spark, d).filter(predicates.lacks_key(F.col("tasks"), "polish_v0-3-1")).select("sample_id")


def _rule_matches(spark, d, conditions):
    s = V.samples(spark, d)
    return s.filter(predicates.compile_conditions(conditions, s.schema))


@query
def rule_filter(spark, d):
    """Every condition kind, each over all samples."""
    kinds = {
        "eq": ("status", "eq", "indexed"), "eq_null": ("status", "eq", None),
        "ne": ("status", "ne", "indexed"), "ne_list": ("kit.name", "ne", ["BUILDING", "MACHINERY"]),
        "gt": ("size", "gt", 500_000), "gte": ("size", "gte", 500_000), "lt": ("size", "lt", 500_000),
        "lte": ("size", "lte", 500_000), "in": ("region", "in", [1, 3]), "nin": ("kit.name", "nin", ["BUILDING", None]),
        "exists": ("pore", "exists", True), "absent": ("pore", "exists", False),
        "array_eq": ("batches", "eq", "B7"), "array_ne": ("batches", "ne", "B7"),
        "array_gt": ("batches", "gt", "B8"),
    }
    s = V.samples(spark, d)
    flags = [predicates.compile_condition(*spec, s.schema).alias(name) for name, spec in kinds.items()]
    return s.select("sample_id", *flags)


@query
def rule_matches(spark, d):
    rule = V.RULES["assemble_v5-0-0"]["conditions"]
    return _rule_matches(spark, d, rule).select("sample_id", "size")


@query
def inventory_filter(spark, d):
    needed = ["is_file", "not_empty", "realpath", "size_gte 5000000", "size_lte 40000000"]
    i = V.files_now(spark, d, FLAGS)
    return i.filter(
        predicates.compile_requirements(needed) & predicates.has_extension(F.col("filepath"), ["fast5", "fastq.gz"])
        & ~predicates.compile_requirements(["is_symlink"])
    ).select("filepath", predicates.requirement_path(needed).alias("path"),
             predicates.requirement_path([]).alias("link"), "size")


@query
def mask_matches(spark, d):
    p = V.page_listing(spark, d)
    name = paths.file_name(F.col("filepath"))
    return p.select(
        "page_id", predicates.matches_mask(name, "*.html").alias("html"),
        predicates.matches_mask(name, "[1-4]?*").alias("digits"), predicates.matches_mask(name, "[!1-4]*").alias("others"),
        predicates.matches_mask(F.col("filepath"), "en/*.html").alias("english"),
        predicates.matches_mask_column(name, F.concat(F.substring(name, 1, 1), F.lit("*"))).alias("own_mask"),
        predicates.matches_mask_column(name, F.when(F.col("page_id") % 2 == 0, "[1-4]?*").otherwise("[!1-4]*")).alias("own_class"),
        predicates.matches_mask_column(F.concat(name, F.lit("$")), F.lit("*$")).alias("dollar"))


@query
def watched_events(spark, d):
    e = V.file_events(spark, d).withColumn("path", F.when(F.col("size") % 2 == 0, F.upper("src_path")).otherwise(
        F.concat("src_path", F.lit(".tmp"))))
    return e.filter(predicates.matches_event_patterns(F.col("path"), ["*.fast5", "*.pod5"])).select("event_id", "path")


@query
def validated_tasks(spark, d):
    t = V.tasks(spark, d)
    shaped = t.select(
        "task_id", F.when(F.col("sorting") == "SJF", "run").when(F.col("timeout") == "3-00:00", "").alias("command"),
        F.when(F.col("status") == "failed", 0).otherwise(2).alias("n_groups"),
        F.when(F.col("status") != "completed", F.col("input_files_size")).otherwise(0).alias("input_files_size"),
        F.when(F.col("pipeline_id") == "assemble_v5-0-0", 0).otherwise(4).alias("n_expected"))
    return work.validate(shaped).select("task_id", "status", F.array_join("reasons", ";").alias("reasons"))


# --- comparing listing and catalog ---------------------------------------------------------------

@query
def snapshot_diff(spark, d):
    return _diff(spark, d).select(
        "symlink", "change_type", "old_filepath", "new_filepath", "old_size", "new_size", "batch", "sample",
        us("old_modified").alias("old_us"), us("new_modified").alias("new_us"))


@query
def snapshot_diff_counts(spark, d):
    return diff.change_counts(_diff(spark, d))


@query
def indexing_counts(spark, d):
    return diff.indexing_counts(_diff(spark, d))


@query
def diff_properties(spark, d):
    return diff.change_log(_diff(spark, d))


@query
def nested_changes(spark, d):
    nested = diff.nested_changes(_diff(spark, d))
    return nested.select(
        "sample", "batch", "symlink", joined(F.array_sort(F.map_keys("changes"))).alias("properties"),
        F.col("changes")["size"]["old"].alias("old_size"), F.col("changes")["size"]["new"].alias("new_size"))


@query
def listing_only(spark, d):
    return diff.listing_only(V.files_now(spark, d), V.catalog_active(spark, d)).select("symlink", "size")


@query
def catalog_only(spark, d):
    return diff.catalog_only(V.files_now(spark, d), V.catalog_active(spark, d)).select("symlink", "size")


@query
def in_both(spark, d):
    return diff.in_both(V.files_now(spark, d), V.catalog_active(spark, d)).select("symlink", "size")


@query
def three_way_keys(spark, d):
    """The same three sets from the keys alone, each side read once."""
    return diff.key_sides(V.files_now(spark, d), V.catalog_active(spark, d))


@query
def dedupe_paths(spark, d):
    return diff.one_per_path(V.repeated_listing(spark, d)).select("filepath")


@query
def one_per_link(spark, d):
    """Moved and unmoved copies of a file share a link name; the smallest path stands for it."""
    both = diff.union_roots(V.files_now(spark, d).select("symlink", "filepath", "size"),
                            V.catalog_active(spark, d).select("symlink", "filepath", "size"))
    return diff.one_per_link(both)


@query
def union_roots(spark, d):
    listing = V.inventory(spark, d).select("filepath", "size")
    reports_ = V.report_listing(spark, d)
    return diff.union_roots(listing, reports_)


@query
def unique_violations(spark, d):
    return rollup.repeated_keys(V.repeated_listing(spark, d), ["ino", "dev"])


@query
def unique_active(spark, d):
    """The (dev, ino) check over catalog rows: repeats among all versions, none among active ones."""
    every = rollup.repeated_keys(V.catalog(spark, d), ["dev", "ino"]).select(F.lit("all").alias("rows"), "dev", "ino", "n")
    alive = rollup.repeated_keys(V.catalog_active(spark, d), ["dev", "ino"]).select(
        F.lit("active").alias("rows"), "dev", "ino", "n")
    return every.unionByName(alive)


# --- rollups -------------------------------------------------------------------------------------

def _flat(rolled):
    return rolled.withColumns({"created": us("created"), "modified": us("modified")})


@query
def batch_rollup(spark, d):
    return _flat(rollup.batch_rollup(_pairs(spark, d)))


@query
def sample_rollup(spark, d):
    return _flat(rollup.sample_rollup(_pairs(spark, d)))


@query
def batch_samples(spark, d):
    return _pairs(spark, d).select("batch", "sample", "n_files", "size")


@query
def batch_sample_sets(spark, d):
    pages = rollup.member_set(_pairs(spark, d), "batch", "sample", page_size=100)
    return pages.select("batch", "page", joined("members").alias("members"))


@query
def batch_file_maps(spark, d):
    pages = rollup.member_map(V.files_now(spark, d), "batch", page_size=100)
    entries = F.transform(F.map_entries("files"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return pages.select("batch", "page", F.size("files").cast("bigint").alias("n_files"),
                        F.sha2(joined(F.array_sort(entries)), 256).alias("files"))


@query
def batch_memberships(spark, d):
    """Documents with member arrays to rows, counted per batch."""
    docs = V.samples(spark, d).select(F.col("sample_id").alias("name"), F.col("batches").alias("samples"))
    rows = rollup.memberships(docs).select(F.col("sample").alias("batch"), F.col("batch").alias("sample"))
    return rows.groupBy("batch").agg(F.countDistinct("sample").alias("n_samples"))


@query
def rollup_delta(spark, d):
    """Batch totals kept by deltas; the check recomputes them."""
    return _flat(rollup.batch_rollup(_kept_pairs(spark, d)))


def _kept_pairs(spark, d):
    """The memberships of the catalog brought up to date; listing and catalog are read once, for the diff."""
    found = written(_diff(spark, d), "diff")
    old = rollup.membership(diff.side_files(found, "old"))
    return rollup.apply_deltas(old, diff.changed_files(found), diff.side_files(found, "new"))


@query
def sample_rollup_delta(spark, d):
    return _flat(rollup.sample_rollup(_kept_pairs(spark, d)))


@query
def affected_batches(spark, d):
    return rollup.affected(_diff(spark, d), "batch")


@query
def affected_samples(spark, d):
    """File to sample cascade: all files of the touched samples."""
    return rollup.affected_totals(V.files_now(spark, d), _diff(spark, d), "sample")


@query
def empty_entities(spark, d):
    s = V.samples(spark, d).select("sample_id", "status")
    return rollup.mark_empty(s, V.files_now(spark, d), "sample_id", "sample")


@query
def hierarchy_totals(spark, d):
    return rollup.hierarchy(_pairs(spark, d)).withColumns({
        "sample": F.coalesce("sample", F.lit("*")), "batch": F.coalesce("batch", F.lit("*"))})


@query
def directory_rollup(spark, d):
    return rollup.directory_rollup(V.files_now(spark, d))


@query
def child_directories(spark, d):
    """Folders nested in folders: the listing's folders and one file in each parent."""
    f = V.files_now(spark, d).select("directory", "size")
    up = f.withColumn("directory", F.regexp_replace("directory", "/[^/]*$", ""))
    return rollup.child_directories(rollup.directory_rollup(f.unionByName(up)))


@query
def member_differences(spark, d):
    return diff.member_differences(
        V.catalog_active(spark, d), V.files_now(spark, d), "batch", "symlink")


# --- versions and row-level changes --------------------------------------------------------------

@query
def version_chain(spark, d):
    chain = versions.version_chain(V.file_versions(spark, d), "symlink", "observed_at")
    return chain.select("symlink", us("observed_at").alias("observed_us"), "fingerprint", "previous_version", "next_version")


@query
def live_version(spark, d):
    return versions.live(V.file_versions(spark, d), "symlink", "observed_at").select("symlink", "size", "fingerprint")


@query
def version_changes(spark, d):
    changed = versions.changes_between_versions(
        V.file_versions(spark, d), "symlink", "observed_at", ["size", "filepath"])
    return changed.withColumn("observed_at", us("observed_at"))


@query
def property_differences(spark, d):
    return diff.property_differences(
        V.catalog_active(spark, d), V.files_now(spark, d), "symlink", ["size", "filepath", "dev"])


def _new_versions(spark, d):
    """New file rows that replace an active one."""
    return _diff(spark, d).filter(F.col("change_type").isin("modified", "moved_modified")).select(
        F.col("new_fingerprint").alias("fingerprint"), F.col("old_fingerprint").alias("previous_version"))


@query
def superseded(spark, d):
    base = V.catalog_active(spark, d).select("symlink", "fingerprint", "status")
    return versions.supersede(base, _new_versions(spark, d), _now()).select(
        "symlink", "status", us("updated_at_DB").alias("updated_us"))


def _base(spark, d):
    return V.catalog_active(spark, d).select("symlink", "filepath", "size", "status", "directory", "basename")


@query
def upsert_files(spark, d):
    changes = V.files_now(spark, d).select("symlink", "filepath", "size")
    merged = versions.merge_snapshot(_base(spark, d), changes, "symlink", _now())
    return merged.select("symlink", "filepath", "size", "status", us("created_at_DB").alias("created_us"),
                         us("updated_at_DB").alias("updated_us"))


@query
def update_files(spark, d):
    changes = V.files_now(spark, d).select("symlink", "size", F.when(
        F.col("dev") == 1, V.ts(V.CATALOG_TIME)).alias("updated_at_DB"))
    merged = versions.merge_snapshot(_base(spark, d), changes, "symlink", _now(), mode="update")
    return merged.select("symlink", "size", "status", us("updated_at_DB").alias("updated_us"),
                         us("created_at_DB").alias("created_us"))


@query
def update_mismatches(spark, d):
    """Updates that would not meet exactly one row of the whole catalog."""
    return versions.match_counts(V.catalog(spark, d), V.files_now(spark, d), "symlink")


@query
def update_many(spark, d):
    out = versions.update_where(_base(spark, d), F.col("size") > 30_000_000, {"status": F.lit("big")}, _now())
    return out.select("symlink", "status", us("updated_at_DB").alias("updated_us"))


@query
def delete_files(spark, d):
    gone = diff.catalog_only(V.files_now(spark, d), V.catalog_active(spark, d))
    return versions.merge_snapshot(_base(spark, d), gone, "symlink", _now(), mode="delete").select("symlink", "size")


@query
def append_files(spark, d):
    new = diff.listing_only(V.files_now(spark, d), V.catalog_active(spark, d)).select("symlink", "size", "status")
    out = versions.merge_snapshot(_base(spark, d).select("symlink", "size", "status"), new, "symlink", _now(), "append")
    return out.select("symlink", "size", "status", us("created_at_DB").alias("created_us"))


@query
def soft_delete(spark, d):
    gone = _diff(spark, d).filter("change_type = 'deleted'")
    out = versions.soft_delete(V.catalog(spark, d), gone, _now())
    return out.select("symlink", "size", "status", us("deleted_at").alias("deleted_us"))


@query
def move_files(spark, d):
    moves = _diff(spark, d).filter(F.col("change_type").isin("moved", "moved_modified"))
    out = versions.move_files(V.catalog(spark, d), moves, _now())
    return out.select("symlink", "size", "status", "filepath", "directory", us("updated_at_DB").alias("updated_us"))


@query
def batch_versions(spark, d):
    """Batches whose content changed, with the version they replace."""
    old = rollup.batch_rollup(_old_pairs(spark, d)).withColumn("status", F.lit("indexed"))
    return versions.next_versions(old, rollup.batch_rollup(_pairs(spark, d)), "batch").select(
        "batch", "size", "fingerprint", "previous_version", "status")


@query
def sample_versions(spark, d):
    old = rollup.sample_rollup(_old_pairs(spark, d)).withColumn("status", F.lit("indexed"))
    return versions.next_versions(old, rollup.sample_rollup(_pairs(spark, d)), "sample").select(
        "sample", "size", "fingerprint", "previous_version", "status")


@query
def vanished_pairs(spark, d):
    """(batch, sample) memberships of the catalog that lost all their files."""
    pair = F.concat_ws(":", "batch", "sample").alias("pair")
    old = _old_pairs(spark, d).select(pair, "n_files", F.lit("indexed").alias("status"))
    return versions.vanished(old, _pairs(spark, d).select(pair), "pair").select("pair", "n_files")


@query
def catalog_roundtrip(spark, d):
    """Two passes written in buckets, folded, compacted and read again."""
    root = run_dir(spark, "catalog")
    columns = ["symlink", "filepath", "size", "fingerprint"]
    old, new = V.catalog_active(spark, d).select(*columns), V.files_now(spark, d).select(*columns)
    for version, rows in enumerate((old, new)):
        tables.append_rows(rows, root, "files", version, tables.bucket("symlink"))
    tables.compact(spark, root, "files", new.schema, "symlink", 1, place=tables.bucket("symlink"))
    return tables.read_live(spark, root, "files", new.schema, "symlink")


@query
def listed_tree(spark, d):
    """A tree that is written here, a folder for each brand, and listed without one of the folders."""
    root = run_dir(spark, "tree")
    V.table(spark, d, "part").select("p_partkey", "p_brand").repartition("p_brand").write.partitionBy("p_brand").parquet(root)
    path = root.removeprefix("file://").removeprefix("file:")
    found = listing.scan_listing(spark, [path], ["parquet"], exclude_dirs=["p_brand=Brand%2311", "p_brand=Brand#11"])
    folder = F.regexp_extract("filepath", "/p_brand=([^/]*)/[^/]*$", 1)
    return found.groupBy(F.regexp_replace(folder, "%23", "#").alias("brand")).agg(
        F.count(F.lit(1)).alias("n_files"), F.min(F.col("size") > 0).alias("with_content"))


@query
def newest_files(spark, d):
    f = V.files_now(spark, d).select("symlink", "size", us("modified").alias("modified_us"))
    return tables.newest_first(f, "modified_us", "symlink").limit(25)


# --- reports -------------------------------------------------------------------------------------

@query
def report_files(spark, d):
    both = diff.union_roots(V.report_listing(spark, d), V.inventory(spark, d).select("filepath"))
    return reports.find_reports(both)


@query
def report_for_batch(spark, d):
    batches = _pairs(spark, d).select("batch").distinct()
    return reports.batch_reports(batches, reports.find_reports(V.report_listing(spark, d)))


# --- choosing work -------------------------------------------------------------------------------

def _rules():
    return rule_source.normalise_rules(V.RULES)


@query
def candidates(spark, d):
    return work.candidates(V.samples(spark, d), _rules())


@query
def candidates_without_tasks(spark, d):
    return work.candidates(V.samples(spark, d), _rules(), V.tasks(spark, d))


@query
def new_tasks(spark, d):
    found = work.candidates(V.samples(spark, d), _rules())
    rules = rule_source.load_rules(spark, V.RULES)
    return work.new_tasks(found, V.samples(spark, d), V.results(spark, d), rules, _now()).select(
        "task_id", "sorting", "timeout", "status", us("created").alias("created_us"))


@query
def rejected_candidates(spark, d):
    found = work.candidates(V.samples(spark, d), _rules())
    out = work.without_documents(found, V.samples(spark, d), V.results(spark, d))
    return out.withColumn("lacking", joined("lacking"))


def _grouped(spark, d):
    files = V.files_now(spark, d, FLAGS).withColumn("task_id", F.col("sample"))
    return work.input_groups(files, V.RULES["polish_v0-3-1"]["input_data"])


@query
def input_groups(spark, d):
    return _grouped(spark, d).select("task_id", "group", "path", "size")


@query
def input_totals(spark, d):
    return work.input_totals(_grouped(spark, d))


@query
def input_sizes(spark, d):
    return work.input_totals(_grouped(spark, d), ["task_id"])


@query
def group_readiness(spark, d):
    all_tasks = V.samples(spark, d).select(F.col("sample_id").alias("task_id"))
    out = work.group_readiness(all_tasks, work.input_totals(_grouped(spark, d)), V.RULES["polish_v0-3-1"]["input_data"])
    return out.withColumns({c: joined(c) for c in ("missing_required", "missing_preferred")})


@query
def queue_usage(spark, d):
    return work.queue_usage(V.tasks(spark, d))


@query
def free_slots(spark, d):
    return work.free_slots(V.tasks(spark, d), V.QUEUES)


@query
def weighted_tasks(spark, d):
    """The full order of every queue: the position key of each prepared task."""
    return work.weighted(V.tasks(spark, d)).select("task_id", "sorting", "ratio", "position")


@query
def admission(spark, d):
    return work.admit(V.tasks(spark, d), V.QUEUES).select(
        "task_id", "sorting", "ratio", F.col("rank").cast("bigint").alias("rank"))


# --- jobs and outputs ----------------------------------------------------------------------------

def _jobs(spark, d):
    return jobs.normalise_jobs(V.raw_jobs(spark, d))


@query
def child_jobs(spark, d):
    return jobs.child_jobs(_jobs(spark, d)).select("job_id", "parent_job_id", "parent_name", "status")


@query
def child_counts(spark, d):
    return jobs.child_counts(_jobs(spark, d))


@query
def child_job_maps(spark, d):
    return jobs.child_map(_jobs(spark, d), page_size=2).select(
        "parent_job_id", "page", joined(F.array_sort(F.map_keys("child_jobs")).cast("array<string>")).alias("children"))


@query
def task_documents(spark, d):
    s = V.samples(spark, d).select("sample_id", "name", "size")
    t = jobs.tasks_in(V.tasks(spark, d), ["prepared", "failed"])
    return jobs.enrich_tasks(t, s, V.results(spark, d)).select(
        "task_id", F.col("sample_meta.name").alias("sample_name"), F.col("result_meta.n_results").alias("n_results"))


def _reconciled_columns(tasks):
    return tasks.select(
        "task_id", "status", "job_status", us("start").alias("start_us"), us("limit").alias("limit_us"),
        us("finish").alias("finish_us"), "exit_code", "time_in_processing", "time_from_creation_to_finish",
        us("last_update").alias("updated_us"))


def _reconciled(spark, d):
    return jobs.reconcile(V.tasks(spark, d), _jobs(spark, d), V.exit_codes(spark, d), _now())


@query
def reconcile_tasks(spark, d):
    return _reconciled_columns(_reconciled(spark, d))


@query
def reconcile_repeated(spark, d):
    """Tasks against a listing that has every job twice, and two exit codes for each: every task comes out once."""
    j, codes = _jobs(spark, d), V.exit_codes(spark, d)
    earlier = j.withColumns({"start": F.col("start") - F.expr("INTERVAL 1 HOUR"), "status": F.lit("BOOT")})
    lower = codes.withColumn("exit_code", (F.col("exit_code") - 1).cast(codes.schema["exit_code"].dataType))
    out = jobs.reconcile(V.tasks(spark, d), j.unionByName(earlier), codes.unionByName(lower), _now())
    return _reconciled_columns(out)


@query
def remaining_queue(spark, d):
    t = V.tasks(spark, d)
    done = jobs.finished(t, _reconciled(spark, d))
    return jobs.drop_finished(jobs.tasks_in(t, work.IN_QUEUE), done).select("task_id", "sorting")


@query
def queued_tasks(spark, d):
    """Tasks handed to the cluster; the hand-over of the largest inputs fails."""
    t = V.tasks(spark, d)
    handed = t.filter("status = 'prepared'").select("task_id", F.when(
        F.col("input_files_size") < 40_000_000, F.substring("task_id", 2, 20).cast("bigint") + 500_000).otherwise(0).alias("job_id"))
    return jobs.queue_task(t, handed, _now()).select(
        "task_id", "status", "job_id", us("queued").alias("queued_us"), "time_in_processing")


@query
def sample_task_states(spark, d):
    """Task states written into the samples' own documents."""
    t = V.tasks(spark, d).withColumn("last_update", F.col("queued"))
    out = jobs.record_in_samples(V.samples(spark, d), t)
    rows = out.select("sample_id", F.explode("tasks").alias("pipeline_id", "entry"))
    return rows.select("sample_id", "pipeline_id", joined(F.map_values("entry")).alias("status"))


@query
def merged_task_tables(spark, d):
    """Two task maps merged by id, the reconciled one winning."""
    old = V.tasks(spark, d).select("task_id", "status", F.lit(0).alias("priority"))
    new = _reconciled(spark, d).filter(F.col("last_update").isNotNull()).select("task_id", "status", F.lit(1).alias("priority"))
    return versions.live(old.unionByName(new), "task_id", "priority").select("task_id", "status")


@query
def expected_outputs(spark, d):
    found = _found(spark, d)
    return outputs.output_totals(outputs.expected_rows(V.expected_outputs(spark, d)), found)


def _found(spark, d, literal=True):
    expected = outputs.expected_rows(V.expected_outputs(spark, d))
    masks = rule_source.masks_of(_rules()) if literal else None
    return outputs.match_outputs(expected, V.listing(spark, d), masks)


@query
def output_files(spark, d):
    return _found(spark, d, literal=False)


@query
def output_sizes(spark, d):
    totals = outputs.output_totals(outputs.expected_rows(V.expected_outputs(spark, d)), _found(spark, d))
    return outputs.task_output_size(totals)


@query
def missing_outputs(spark, d):
    return outputs.missing_outputs(outputs.output_totals(
        outputs.expected_rows(V.expected_outputs(spark, d)), _found(spark, d)))


@query
def overlaid_outputs(spark, d):
    """Byte totals per slot, replaced or completed by a shaper's values."""
    totals = _found(spark, d).groupBy(*outputs.SLOT).agg(F.sum("size").cast("string").alias("value"))
    shaped = V.listing(spark, d).groupBy("task_id").agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        "task_id", F.lit("plots").alias("group"), F.explode(F.array(F.lit("page"), F.lit("summary"))).alias("type"), "value")
    return outputs.overlay(totals, shaped)


@query
def rerun_list(spark, d):
    totals = outputs.output_totals(outputs.expected_rows(V.expected_outputs(spark, d)), _found(spark, d))
    return outputs.rerun_list(V.tasks(spark, d), totals).select("task_id", "status", "n_missing")


def _shapers(spark, d):
    """A declarative shaper for one rule, a pandas one for another, none for the third."""
    registry = shapers.Shapers()
    template = V.RULES["polish_v0-3-1"]["command_template"]

    def declarative(t):
        return t.withColumns({
            "command": templates.render(template, {"SAMPLE": F.col("sample_id")}),
            "n_groups": F.lit(1), "n_expected": F.lit(3)})

    def rowwise(frame):
        frame = frame[["task_id", "pipeline_id", "status", "input_files_size"]].copy()
        frame["command"] = "assemble " + frame["task_id"]
        frame["n_groups"] = 1
        frame["n_expected"] = (frame["input_files_size"] > 20_000_000).astype("int64")
        return frame

    schema = ("task_id string, pipeline_id string, status string, input_files_size bigint, command string, "
              "n_groups bigint, n_expected bigint")

    def output(t):
        return t.select("task_id", F.lit("data").alias("group"), F.lit("bytes").alias("type"),
                        F.col("input_files_size").cast("string").alias("value"))

    registry.register("polish_v0-3-1", declarative, output)
    registry.register("assemble_v5-0-0", shapers.row_shaper(rowwise, schema), output)
    return registry


@query
def shaped_inputs(spark, d):
    out = _shapers(spark, d).shape_inputs(V.tasks(spark, d))
    return out.select("task_id", "status", "command", F.array_join("reasons", ";").alias("reasons"))


@query
def shaped_outputs(spark, d):
    return _shapers(spark, d).shape_outputs(V.tasks(spark, d).filter("status = 'completed'"))


# --- events --------------------------------------------------------------------------------------

@query
def debounced_events(spark, d):
    kept = ordered.settled(V.file_events(spark, d), ["src_path"], "ts", 6 * HOUR, tie=["event_id"])
    return kept.select("event_id", "src_path", us("ts").alias("ts_us"))


@query
def event_sessions(spark, d):
    out = ordered.sessions(
        V.file_events(spark, d), ["src_path"], "ts", 6 * HOUR,
        [F.count(F.lit(1)).alias("n_events"), F.sum("size").alias("size")], tie=["event_id"])
    return out.select("src_path", us("session_start").alias("start_us"), us("session_end").alias("end_us"),
                      "n_events", "size")


@query
def batch_holds(spark, d):
    """Ten-minute stability of batches: bursts per batch, as the hold releases them."""
    e = V.file_events(spark, d).withColumn("batch", paths.batch_name(F.col("src_path")))
    out = ordered.sessions(e, ["batch"], "ts", 600, [F.count(F.lit(1)).alias("n_events")], tie=["event_id"])
    return out.select("batch", us("session_start").alias("start_us"), us("session_end").alias("end_us"), "n_events")


@query
def settling_batches(spark, d):
    now = V.ts("2001-08-01 00:05:00")
    out = curation.settling(rollup.batch_rollup(_pairs(spark, d)), now)
    return out.select("batch", "debounce")


@query
def state_transitions(spark, d):
    polls = V.file_events(spark, d).select(
        F.col("src_path").alias("task_id"), F.col("event_type").alias("status"), F.col("ts").alias("polled_at"))
    out = jobs.state_transitions(polls, bucket_seconds=12 * HOUR)
    return out.select("task_id", us("polled_at").alias("polled_us"), "previous_status", "status")


# --- curation ------------------------------------------------------------------------------------

def _curated(spark, d):
    batches = rollup.batch_rollup(_pairs(spark, d))
    runs = V.batch_runs(spark, d)
    with_pore = curation.lookup(batches, runs, "batch", "batch", "pore", "pore")
    return curation.curate_batches(curation.lookup(with_pore, runs, "batch", "batch", "experiment_type", "experiment_type"))


@query
def curation_needed(spark, d):
    return curation.curations(_curated(spark, d)).select("batch", "size", joined("unknowns").alias("unknowns"))


@query
def released_batches(spark, d):
    """Held batches looked up again in reference data that has every pore by now."""
    held = curation.curations(_curated(spark, d))
    known = held.withColumn("pore", F.coalesce("pore", F.lit("R9")))
    return curation.released(known).select("batch", "pore", "experiment_type")


@query
def chemistry_codes(spark, d):
    """Code tables small enough to be literals, looked up from the parts' names."""
    p = V.table(spark, d, "part")
    cell = F.when(F.col("p_type") == "SMALL", "FLO-PRO002").when(F.col("p_type") == "LARGE", "FLO-MIN114").otherwise("?")
    kit = F.when(F.col("p_size") > 25, "SQK-LSK109").when(F.col("p_size") > 10, "SQK-RBK114.24")
    return p.select("p_partkey", curation.lookup_code(cell, curation.PORES).alias("pore"),
                    curation.lookup_code(kit, curation.CHEMISTRIES).alias("chemistry"))


@query
def sample_ready(spark, d):
    return curation.sample_readiness(_pairs(spark, d), _curated(spark, d))


@query
def curated_sample_rollup(spark, d):
    """Sample totals without the files of held batches."""
    return _flat(rollup.sample_rollup(curation.clear_pairs(_pairs(spark, d), _curated(spark, d))))


@query
def run_groups(spark, d):
    return curation.run_groups(_pairs(spark, d), _curated(spark, d))


# --- whole passes --------------------------------------------------------------------------------

def _indexed(spark, d):
    """A catalog made from the previous listing and synced with the present one."""
    root = run_dir(spark, "indexed")
    before = V.previous_inventory(spark, d).filter("state is null or state = 'indexed'")
    indexing.sync_listing(spark, root, before, V.LINK_DIR, V.ts(V.CATALOG_TIME))
    indexing.sync_listing(spark, root, V.inventory(spark, d), V.LINK_DIR, _now(),
                          reports=reports.find_reports(V.report_listing(spark, d)))
    return root


@query
def indexed_files(spark, d):
    """Every file version the two passes left, with the links between them."""
    columns = ["symlink", "born", "filepath", "size", "status", "previous_version", "next_version", "deleted_at"]
    return indexing.read_files(spark, _indexed(spark, d), columns=columns).select(
        "symlink", "born", "filepath", "size", "status", "previous_version", "next_version",
        us("deleted_at").alias("deleted_us"))


@query
def indexed_batches(spark, d):
    return indexing.read_batches(spark, _indexed(spark, d)).select(
        "batch", "born", "n_files", "size", "status", "fingerprint", "previous_version", "next_version",
        "final_summary")


@query
def indexed_samples(spark, d):
    return indexing.current_samples(spark, _indexed(spark, d)).select(
        "sample", "n_batches", "n_files", "size", "fingerprint", "sample_id", "result_dir")


def _curation(spark, d, version):
    """Runs with a flow cell for each region and a kit for each nation; the first codes lack some, the second fewer."""
    n, r = V.table(spark, d, "nation"), V.table(spark, d, "region")
    runs = n.select(F.concat(F.lit("B"), "n_nationkey").alias("batch"), F.concat(F.lit("FC"), "n_regionkey").alias("flow_cell"),
                    F.concat(F.lit("K"), "n_nationkey").alias("kit"))
    cells = r.filter(F.lit(version > 1) | (F.col("r_name") != "ASIA")).select(
        F.lit("pore").alias("kind"), F.concat(F.lit("FC"), "r_regionkey").alias("code"), F.col("r_name").alias("value"))
    kits = n.filter("n_nationkey <> 7").select(F.lit("experiment_type"), F.concat(F.lit("K"), "n_nationkey"), F.lit("dna"))
    return plan_curation.Curation(runs, cells.union(kits), f"v{version}", hold_seconds=None)


def _curated_passes(spark, d):
    """Two passes with codes that leave batches waiting, and a third, over the same listing, with more codes."""
    root = run_dir(spark, "curated")
    before = V.previous_inventory(spark, d).filter("state is null or state = 'indexed'")
    for listing, now, codes in ((before, V.ts(V.CATALOG_TIME), 1), (V.inventory(spark, d), _now(), 1), (V.inventory(spark, d), _now(), 2)):
        indexing.sync_listing(spark, root, listing, V.LINK_DIR, now, curation=_curation(spark, d, codes))
    return root


@query
def curated_passes(spark, d):
    """Sample totals after the third pass: of the batches that were known, and of those it released."""
    return indexing.current_samples(spark, _curated_passes(spark, d)).select("sample", "n_batches", "n_files", "size", "fingerprint")


@query
def curations_kept(spark, d):
    """What the three passes keep of batches that wait or have waited."""
    return plan_curation.read_curations(spark, _curated_passes(spark, d)).select(
        "batch", "held", joined("unknowns").alias("unknowns"), "refs_version")


@query
def resting_batches(spark, d):
    """Sample totals of a pass at a time when some batches have not come to rest."""
    n = V.table(spark, d, "nation").limit(0)
    curation_ = plan_curation.Curation(n.select(F.col("n_name").alias("batch")), n.select(
        *[F.col("n_name").alias(c) for c in ("kind", "code", "value")]), "v0", needed={})
    root = run_dir(spark, "resting")
    indexing.sync_listing(spark, root, V.inventory(spark, d), V.LINK_DIR, V.ts("2001-08-01 00:05:00"), curation=curation_)
    return indexing.current_samples(spark, root).select("sample", "n_batches", "n_files", "size")


@query
def model_lookup(spark, d):
    """The newest basecalling model at or below a version, for parts taken as runs; and the newest that calls a modified base."""
    p = V.table(spark, d, "part")
    keys = ["pore", "chemistry", "speed", "kind"]
    runs = p.select(
        "p_partkey", F.when(F.col("p_size") > 25, "r10.4.1").otherwise("r9.4.1").alias("pore"),
        F.when(F.col("p_size") > 25, "e8.2").otherwise("e8").alias("chemistry"),
        F.when(F.col("p_size") > 38, "400").when(F.col("p_size") > 25, "260").otherwise("").alias("speed"),
        F.element_at(F.array(*map(F.lit, ("fast", "hac", "sup"))), (F.col("p_partkey") % 3 + 1).cast("int")).alias("kind"),
        F.element_at(F.array(*map(F.lit, ("5mCG", "6mA", "5mCG_5hmCG"))), (F.col("p_size") % 3 + 1).cast("int")).alias("modification"),
        curation.version_parts(F.concat(F.lit(3) + F.col("p_partkey") % 3, F.lit("."), F.col("p_size") % 8)).alias("version"))
    models = curation.model_table(spark)
    any_base = curation.newest_up_to(runs, models, keys, "version", ["model", "freq"])
    calling = curation.by_modification(models).withColumnRenamed("model", "calling")
    found = curation.newest_up_to(any_base, calling, [*keys, "modification"], "version", ["calling", "modification_version"])
    return found.select("p_partkey", "model", "freq", "modification", "calling", "modification_version")


@query
def scheduling_cycle(spark, d):
    """One cycle over all tasks: their next states, and which of them get a slot."""
    cycle = scheduling.run_cycle(
        V.tasks(spark, d), _jobs(spark, d), V.exit_codes(spark, d),
        V.samples(spark, d).withColumn("input_files_size", F.col("size")), V.results(spark, d), _rules(),
        rule_source.load_rules(spark, V.RULES), _cycle_shapers(spark, d), V.QUEUES, _now())
    admitted = cycle.admitted.select("task_id", F.col("rank").cast("bigint").alias("rank"))
    return cycle.tasks.select("task_id", "status", "sorting").join(admitted, "task_id", "left")


def _sample_bytes(spark, d):
    """The bytes of each sample's files, written: every rule and every cycle reads them, and the listing is gone through once."""
    return written(_pairs(spark, d).groupBy(F.col("sample").alias("sample_id")).agg(F.sum("size").alias("input_files_size")), "sample-bytes")


def _cycle_shapers(spark, d):
    """Shapers that take a task's bytes from its sample's files."""
    totals = _sample_bytes(spark, d)

    def shape(t):
        return t.join(totals, "sample_id", "left").withColumns({
            "command": F.concat(F.lit("run "), "task_id"), "n_groups": F.lit(1), "n_expected": F.lit(1)})

    def none(t):
        return t.select("task_id", F.lit("").alias("group"), F.lit("").alias("type"), F.lit("").alias("value"))

    registry = shapers.Shapers()
    for rule in ("polish_v0-3-1", "assemble_v5-0-0"):
        registry.register(rule, shape, none)
    return registry


# --- streams -------------------------------------------------------------------------------------

@query
def event_diff(spark, d):
    found = events.event_diff(V.change_events(spark, d), V.catalog(spark, d), V.LINK_DIR)
    return found.select("symlink", "change_type", "new_filepath", "new_size")


@query
def rejected_events(spark, d):
    found = events.event_diff(V.change_events(spark, d), V.catalog(spark, d), V.LINK_DIR)
    return events.rejected(found).select("symlink", "reason")


# Where the stream queries cut their rows: each part arrives after the stream has stopped, and starts it again.
CUTS = ["2024-01-10", "2024-01-20"]


def _in_parts(spark, rows, name, run, cuts=CUTS, ts="ts"):
    """Rows dropped into a folder part by part, the first and the last open-ended; the stream runs after each."""
    path = run_dir(spark, name)
    number = F.lit(0)
    for cut in cuts:
        number = number + F.coalesce(F.col(ts) >= V.ts(cut), F.lit(False)).cast("int")
    for k in range(len(cuts) + 1):
        rows.filter(number == k).write.mode("append").parquet(path)
        run(path)


def _bursts(spark, rows, keys, name, start, payload=()):
    """What a debounce stream settles over several runs, and what it then still holds open."""
    target, checkpoint = run_dir(spark, name), run_dir(spark, name + "-checkpoint")
    _in_parts(spark, rows, name + "-events", lambda path: event_stream.start(
        start(event_stream.read_events(spark, path, schema=rows.schema)), target, checkpoint).awaitTermination())
    held = event_stream.open_bursts(spark, checkpoint, keys, payload)
    return spark.read.schema(held.schema).parquet(target).unionByName(held)


@query
def stream_debounce(spark, d):
    """The per-file debounce as a stream that stops twice."""
    rows = V.file_events(spark, d).select("event_id", "src_path", "ts", "size")
    found = _bursts(spark, rows, ["src_path"], "debounced", lambda events: event_stream.debounce(
        events, ["src_path"], gap="6 hours", payload=["event_id"], tie=["event_id"]), ["event_id"])
    return found.select("src_path", us("session_start").alias("start_us"), us("settled_at").alias("settled_us"), "n_events", "event_id")


@query
def stream_batch_holds(spark, d):
    """The ten-minute hold of batches as a stream that stops twice."""
    rows = V.file_events(spark, d).select("src_path", "ts")
    found = _bursts(spark, rows, ["batch"], "held", event_stream.hold_batches)
    return found.select("batch", us("session_start").alias("start_us"), us("settled_at").alias("end_us"), "n_events")


@query
def stream_sync(spark, d):
    """A stored catalog kept up to date by a stream of file events; its batches afterwards."""
    root = run_dir(spark, "synced")
    before = V.previous_inventory(spark, d).filter("state is null or state = 'indexed'")
    first = indexing.sync_listing(spark, root, before, V.LINK_DIR, V.ts(V.CATALOG_TIME)) + 1
    rows, checkpoint = V.change_events(spark, d), run_dir(spark, "sync-checkpoint")
    cuts = ["2002-01-01 00:02:00", "2002-01-01 00:03:00"]
    _in_parts(spark, rows, "change-events", lambda path: event_stream.sync_catalog(
        event_stream.read_events(spark, path, schema=rows.schema), root, V.LINK_DIR, _now(), checkpoint, first
    ).awaitTermination(), cuts)
    return _flat(indexing.current_batches(spark, root).select(
        "batch", "n_samples", "n_files", "size", "created", "modified", "fingerprint"))


@query
def stream_quiet_sync(spark, d):
    """The same with modifications that wait for quiet, and logs that are rotated within seconds; at the end what still waits."""
    root = run_dir(spark, "quiet")
    before = V.previous_inventory(spark, d).filter("state is null or state = 'indexed'")
    first = indexing.sync_listing(spark, root, before, V.LINK_DIR, V.ts(V.CATALOG_TIME)) + 1
    rows, checkpoint = V.change_events(spark, d).unionByName(V.rotated_logs(spark, d)), run_dir(spark, "quiet-checkpoint")
    cuts = ["2002-01-01 00:02:00", "2002-01-01 00:03:00"]
    _in_parts(spark, rows, "quiet-events", lambda path: event_stream.sync_catalog(
        event_stream.quiet_events(event_stream.read_events(spark, path, schema=rows.schema)), root, V.LINK_DIR, _now(), checkpoint, first
    ).awaitTermination(), cuts)
    indexing.sync_events(spark, root, event_stream.open_modifications(spark, checkpoint), V.LINK_DIR, _now())
    return indexing.current_batches(spark, root).select("batch", "n_files", "size")


@query
def stream_transitions(spark, d):
    """Job-state changes with stored state, the polls arriving in three parts."""
    polls = V.file_events(spark, d).select(
        F.col("src_path").alias("task_id"), F.col("ts").alias("polled_at"), F.col("event_type").alias("status"))
    root, checkpoint = run_dir(spark, "transitions"), run_dir(spark, "transitions-checkpoint")
    _in_parts(spark, polls, "polls", lambda path: state_stream.track_transitions(
        event_stream.read_events(spark, path, schema=polls.schema), root, checkpoint).awaitTermination(), ts="polled_at")
    return state_stream.read_transitions(spark, root).select(
        "task_id", us("polled_at").alias("polled_us"), "previous_status", "status")


@query
def stream_entities(spark, d):
    """Running batch totals with stored state, beginning with the stored catalog; deltas come in three parts."""
    rows = rollup.contributions(_diff(spark, d)).select(
        F.col("batch").alias("name"), F.col("sign").cast("bigint").alias("n_files"),
        (F.col("size") * F.col("sign")).alias("size"), F.col("modified").alias("ts"))
    stored = written(rollup.batch_rollup(_old_pairs(spark, d)).select(F.col("batch").alias("name"), "n_files", "size"), "stored")
    root, checkpoint = run_dir(spark, "entities"), run_dir(spark, "entities-checkpoint")
    _in_parts(spark, written(rows, "contributions"), "deltas", lambda path: state_stream.track_totals(
        event_stream.read_events(spark, path, schema=rows.schema).drop("ts"), stored, root, checkpoint).awaitTermination(),
        ["1996-01-01", "1999-01-01"])
    return state_stream.read_totals(spark, root)


@query
def report_set(spark, d):
    return events.report_set(V.report_events(spark, d))


@query
def stream_reports(spark, d):
    """The set of report files as a running answer over three parts."""
    rows = V.report_events(spark, d)
    root, checkpoint = run_dir(spark, "report-set"), run_dir(spark, "reports-checkpoint")
    _in_parts(spark, rows, "report-events", lambda path: state_stream.track_reports(
        event_stream.read_events(spark, path, schema=rows.schema), root, checkpoint).awaitTermination())
    return state_stream.read_reports(spark, root)


# --- rows that are easily lost -------------------------------------------------------------------

@query
def null_time_neighbours(spark, d):
    """Events without a time come first in their key and are neighbours like others."""
    near = ordered.with_neighbours(V.untimed_events(spark, d), ["src_path"], "ts", [F.col("event_id")], before="_before",
                                   after="_after", tie=["event_id"])
    return near.select("event_id", F.col("_before.event_id").alias("before_id"), F.col("_after.event_id").alias("after_id"))


@query
def null_time_settled(spark, d):
    kept = ordered.settled(V.untimed_events(spark, d), ["src_path"], "ts", 6 * HOUR, tie=["event_id"])
    return kept.select("event_id", "src_path", us("ts").alias("ts_us"))


@query
def null_time_sessions(spark, d):
    out = ordered.sessions(V.untimed_events(spark, d), ["src_path"], "ts", 6 * HOUR,
                           [F.count(F.lit(1)).alias("n_events")], tie=["event_id"])
    return out.select("src_path", us("session_start").alias("start_us"), us("session_end").alias("end_us"), "n_events")


def _ruleless(spark, d):
    return V.tasks(spark, d).withColumn("pipeline_id", F.when(F.col("input_files_size") % 3 != 0, F.col("pipeline_id")))


@query
def ruleless_inputs(spark, d):
    """Tasks some of which have no rule: every one is judged."""
    out = _shapers(spark, d).shape_inputs(_ruleless(spark, d))
    return out.select("task_id", "status", "command", F.array_join("reasons", ";").alias("reasons"))


@query
def unshaped_tasks(spark, d):
    """What the output shapers leave out, with the reason."""
    return _shapers(spark, d).unshaped(_ruleless(spark, d)).select("task_id", "reason")


@query
def queue_heads(spark, d):
    """A queue of 2 beside one of 2,000: each gives its own number at most."""
    heads = work.first_per_queue(V.tasks(spark, d), {"SJF": 2, "LJF": 2000})
    return heads.select("task_id", "sorting", F.col("rank").cast("bigint").alias("rank"))


@query
def long_timeouts(spark, d):
    """Timeouts of any number of digits."""
    text = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 9, "1"), F.lit("-"), F.col("o_custkey"), F.lit(":0000000007"))
    o = V.table(spark, d, "orders")
    return o.select("o_orderkey", durations.timeout_minutes(text).alias("minutes"))


@query
def rejected_files(spark, d):
    """Listed files whose path names no sample, as a pass records them."""
    root = run_dir(spark, "rejects")
    indexing.sync_listing(spark, root, V.shallow_inventory(spark, d), V.LINK_DIR, _now())
    return indexing.read_rejects(spark, root).select("symlink", "reason")


@query
def reports_over_passes(spark, d):
    """Reports found in the second of three passes stay with the versions that the third makes."""
    root = _indexed(spark, d)
    grown = V.inventory(spark, d).withColumn("size", F.col("size") + (F.col("ino") % 7 == 0).cast("bigint"))
    indexing.sync_listing(spark, root, grown, V.LINK_DIR, _now())
    return indexing.current_batches(spark, root).select("batch", "n_files", "size", "final_summary", "sequencing_summary")


@query
def renamed_in_batch(spark, d):
    """Files made under a temporary name and renamed twice within one batch of events."""
    found = events.event_diff(V.renaming_events(spark, d), V.catalog(spark, d), V.LINK_DIR)
    return found.select("symlink", "change_type", "new_filepath", "new_size")


@query
def renamed_files(spark, d):
    """Moves that change sample and file name: link, type, batch and sample follow."""
    path = F.regexp_replace(F.regexp_replace("filepath", "^/src/S", "/src/T"), "/([^/]*)$", "/n-$1")
    moves = V.catalog_active(spark, d).filter("size % 2 = 0").select("symlink", path.alias("new_filepath"))
    out = versions.move_files(V.catalog(spark, d), moves, _now(), V.LINK_DIR)
    return out.select("symlink", "filepath", "name", "batch", "sample", "extension", "directory", "size", "status")


@query
def completed_cycle(spark, d):
    """Three stored cycles: tasks are handed over, run, and end; what the completed ones put out."""
    root = run_dir(spark, "cycles")
    customers = V.table(spark, d, "customer").select("c_custkey")
    heads = customers.select(F.explode(F.array(F.col("c_custkey") * 10 + 1, F.col("c_custkey") * 10 + 2)).alias("job_id"))
    none = F.lit(None)
    running = heads.select(
        "job_id", F.lit("head").alias("name"), F.lit(0).cast("bigint").alias("parent_job_id"), F.lit("RUNNING").alias("status"),
        none.cast("int").alias("exit_code"), F.lit("/w").alias("work_dir"), _now().alias("start"), _now().alias("limit"))
    codes = heads.select("job_id", F.when(F.floor(F.col("job_id") / 10) % 3 == 0, 1).otherwise(0).alias("exit_code"))

    def hand_over(admitted):
        number = F.regexp_extract("task_id", "^S([0-9]+)_", 1).cast("bigint") * 10
        return admitted.select("task_id", (number + F.when(F.col("pipeline_id") == "polish_v0-3-1", 1).otherwise(2)).alias("job_id"))

    totals = _sample_bytes(spark, d)

    def shape(t):
        return t.join(totals, "sample_id", "left").withColumns(
            {"command": F.concat(F.lit("run "), "task_id"), "n_groups": F.lit(1), "n_expected": F.lit(1)})

    def output(t):
        return t.select("task_id", F.lit("plots").alias("group"), F.lit("page").alias("type"),
                        F.concat(F.lit("shaped "), "sample_id").alias("value"))

    registry = shapers.Shapers()
    for rule in ("polish_v0-3-1", "assemble_v5-0-0"):
        registry.register(rule, shape, output)
    listing = V.listing(spark, d).withColumn("task_id", F.concat(
        F.lit("S"), F.regexp_extract("filepath", "_([0-9]+)(_a|_ab)?[.][a-z]+$", 1), F.lit("_polish_v0-3-1")))
    given = dict(samples=V.samples(spark, d).drop("tasks"), results=written(V.results(spark, d), "documents"), rules=_rules(),
                 rules_table=rule_source.load_rules(spark, V.RULES), shapers=registry, capacity={"SJF": 10**6, "LJF": 10**6},
                 now=F.current_timestamp(), hand_over=hand_over, listing=listing)
    for listed, ended in ((running.limit(0), codes.limit(0)), (running, codes.limit(0)), (running.limit(0), codes)):
        scheduling.run_stored_cycle(spark, root, listed, ended, **given)
    return scheduling.read_results(spark, root).select("task_id", "pipeline_id", "group", "type", "value")
