"""Identity derived from a file's path.

A source file lives at ``.../{sample}/{a}_{b}_{c}_{batch}/{subdir}/{file}``.
"""

from pyspark.sql import Column, DataFrame, functions as F

# The source file types, and the folder for anything else.
SOURCE_TYPES = ("fast5", "fastq", "fq", "pod5")
UNKNOWN_TYPE = "unknown_extension"
# The report kinds looked for in file names.
REPORT_TYPES = ("final_summary", "sequencing_summary")


def clean_path(path: Column) -> Column:
    """Drop a URI scheme and authority, and squeeze repeated slashes."""
    local = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/", "/")
    return F.regexp_replace(local, "//+", "/")


def _part(path, from_end):
    """A component of an absolute path counted from its end; empty when there are not so many."""
    return F.substring_index(F.substring_index(path, "/", -from_end), "/", 1)


def batch_name(path: Column) -> Column:
    """The run folder's name without its first three ``_`` tokens; empty when it has no more."""
    return F.regexp_extract(_part(path, 3), "^[^_]*_[^_]*_[^_]*_(.*)$", 1)


def sample_name(path: Column) -> Column:
    """The fourth component from the end; empty on a path that has none."""
    return _part(path, 4)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def basename(name: Column) -> Column:
    """The name up to its first dot."""
    return F.substring_index(name, ".", 1)


def extension(name: Column) -> Column:
    """The first suffix that is a source type; compression suffixes are ignored."""
    return _known_type(_type_text(name))


def _type_text(name):
    return F.lower(F.regexp_extract(name, r"[^/]\.(" + "|".join(SOURCE_TYPES) + r")(\.|$)", 1))


def _known_type(text):
    return F.when(text != "", text)


def link_folder(name: Column) -> Column:
    return F.coalesce(extension(name), F.lit(UNKNOWN_TYPE))


def link_name(batch: Column, sample: Column, name: Column) -> Column:
    return F.concat_ws(":", batch, sample, name)


def first_token(name) -> Column:
    """The part of a link's or batch's name before the first colon: the same for a batch and for the links of its files."""
    return F.substring_index(name, ":", 1)


def link_path(link_dir: Column, batch: Column, sample: Column, name: Column) -> Column:
    return F.concat_ws("/", link_dir, link_name(batch, sample, name))


def report_type(name: Column) -> Column:
    """The report kind whose name occurs in a ``.txt`` file's name, else null."""
    kind = F.lit(None).cast("string")
    for known in reversed(REPORT_TYPES):
        kind = F.when(F.contains(name, F.lit(known)), F.lit(known)).otherwise(kind)
    return F.when(F.endswith(name, F.lit(".txt")), kind)


def sample_id(name: Column, fingerprint: Column) -> Column:
    return F.concat_ws("_", name, F.substring(fingerprint, 1, 6))


def entity_dir(base: Column, name: Column, fingerprint: Column) -> Column:
    return F.concat_ws("/", base, name, F.substring(fingerprint, 1, 6))


def task_id(sample: Column, pipeline_id: Column) -> Column:
    return F.concat_ws("_", sample, pipeline_id)


def task_dirs(df: DataFrame) -> DataFrame:
    """Add a task's folders and head-job file paths.

    Needs ``task_id, processing_dir, result_dir, pipeline_name, pipeline_version``.
    """
    step = F.concat_ws("/", "pipeline_name", F.replace("pipeline_version", F.lit("."), F.lit("")))
    work = F.concat_ws("/", F.col("processing_dir"), step)
    result = F.concat_ws("/", F.col("result_dir"), step)
    logs = F.concat(result, F.lit("/logs"))
    stream = F.concat(logs, F.lit("/slurm/"), F.col("task_id"))
    return df.withColumns({
        "work_dir": work,
        "task_result_dir": result,
        "log_dir": logs,
        "head_job_stdout": F.concat(stream, F.lit(".stdout")),
        "head_job_stderr": F.concat(stream, F.lit(".stderr")),
        "head_job_exitcode_f": F.concat(work, F.lit("/"), F.col("task_id"), F.lit(".exitcode")),
    })


def with_identity(df: DataFrame, link_dir: str, path: str = "filepath") -> DataFrame:
    """Add batch, sample, link, names, directory and type to rows that have an absolute path.

    Done in steps, so that every string is cut once and not again for each column made from it.
    """
    folder = F.lit(link_dir.rstrip("/"))
    cut = df.withColumns({
        "batch": batch_name(F.col(path)), "sample": sample_name(F.col(path)), "_file": file_name(F.col(path))})
    named = cut.withColumns({
        "directory": F.substr(F.col(path), F.lit(1), F.length(path) - F.length("_file") - 1),
        "basename": basename(F.col("_file")), "_type": _type_text(F.col("_file")),
        "name": link_name(F.col("batch"), F.col("sample"), F.col("_file")),
    })
    typed = named.withColumns({
        "extension": _known_type(F.col("_type")),
        "symlink_dir": F.concat_ws("/", folder, F.when(F.col("_type") != "", F.col("_type")).otherwise(UNKNOWN_TYPE)),
    })
    return typed.withColumn("symlink", F.concat_ws("/", "symlink_dir", "name")).drop("_file", "_type")


def has_identity(df: DataFrame) -> DataFrame:
    """Keep rows whose path is deep enough to name a sample."""
    return df.filter(F.col("sample") != "")
