"""File -> batch -> sample rollups.

Everything is built on the (batch, sample) membership table, which is one partially aggregated pass
over the files. Its aggregates merge, so batches and samples are second, much smaller aggregations,
and a change to some files is applied by adding and subtracting contributions.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.fingerprints import (
    WORDS, fingerprint_words, merge_words, set_fingerprint, sum_words,
)

PAIR = ["batch", "sample"]


def membership(files: DataFrame) -> DataFrame:
    """Per (batch, sample): file count, size, time range and accumulated fingerprint words."""
    return files.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size"),
        F.min("created").alias("created"), F.max("modified").alias("modified"),
        *sum_words(F.col("fingerprint")),
    )


def _merged(pairs, key, other):
    return pairs.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"n_{other}"), F.sum("n_files").alias("n_files"),
        F.sum("size").alias("size"), F.min("created").alias("created"),
        F.max("modified").alias("modified"), *merge_words(),
    )


def _finished(rollup):
    return rollup.withColumn("fingerprint", set_fingerprint(F.col("n_files"))).drop(*WORDS)


def batch_rollup(pairs: DataFrame) -> DataFrame:
    return _finished(_merged(pairs, "batch", "samples"))


def dated_sample_rollup(pairs: DataFrame, batches: DataFrame) -> DataFrame:
    """``sample_rollup`` of whole samples' pairs, the time ranges taken from the batches' own rows."""
    ranges = batches.select("batch", F.col("created").alias("_created"), F.col("modified").alias("_modified"))
    dated = pairs.join(ranges, "batch").withColumns({"created": F.col("_created"), "modified": F.col("_modified")})
    return _finished(_merged(dated, "sample", "batches"))


def sample_rollup(pairs: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Sizes and fingerprint from the sample's own files, the time range from its whole batches.

    ``names`` limits the result to some samples; ``pairs`` must hold their batches completely.
    """
    ranges = pairs.groupBy("batch").agg(
        F.min("created").alias("_created"), F.max("modified").alias("_modified"))
    own = pairs if names is None else pairs.join(names, "sample", "left_semi")
    return dated_sample_rollup(own, ranges.select("batch", F.col("_created").alias("created"), F.col("_modified").alias("modified")))


def members(pairs: DataFrame, entity: str, member: str) -> DataFrame:
    """The entity's member set as rows."""
    return pairs.select(entity, member).distinct()


def memberships(batches: DataFrame, name: str = "name", members: str = "samples") -> DataFrame:
    """Rows (batch, sample) out of documents that hold the member names as an array."""
    return batches.select(F.col(name).alias("batch"), F.explode(members).alias("sample"))


def member_set(pairs: DataFrame, entity: str, member: str, page_size: int = 10_000) -> DataFrame:
    """The member set as sorted arrays, in pages of about ``page_size`` names.

    A small entity has the one page 0, which is the whole set.
    """
    keyed = members(pairs, entity, member).withColumn("_id", F.col(member))
    return _paged(keyed, entity, page_size).groupBy(entity, "page").agg(
        F.array_sort(F.collect_list(member)).alias("members"))


def member_map(files: DataFrame, entity: str, page_size: int = 10_000) -> DataFrame:
    """``{link: fingerprint}`` of an entity's files, in pages of about ``page_size`` entries.

    An entity may own any share of all files, so a page and never an entity is one row; a small
    entity has the one page 0, which is the whole map.
    """
    keyed = files.select(entity, "symlink", "fingerprint").withColumn("_id", F.col("symlink"))
    entries = F.array_sort(F.collect_list(F.struct("symlink", "fingerprint")))
    return _paged(keyed, entity, page_size).groupBy(entity, "page").agg(
        F.map_from_entries(entries).alias("files"))


def _paged(rows, entity, page_size):
    return paged(rows, entity, F.col("_id"), page_size).drop("_id")


def paged(rows: DataFrame, entity: str, member, page_size: int, counts: DataFrame | None = None) -> DataFrame:
    """Spread an entity's rows over count / page_size pages by a hash of the member's name.

    ``counts`` are (entity, n) where they are known. Rows go on by entity and page: since that is another exchange,
    adaptive execution may split the join of an entity that has any share of all rows, and nothing is copied.
    """
    if counts is None:
        counts = rows.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    pages = counts.select(entity, F.ceil(F.col("n") / F.lit(page_size)).cast("bigint").alias("_pages"))
    slot = F.conv(F.substring(F.sha2(member, 256), 1, 12), 16, 10).cast("bigint")
    return rows.join(pages, entity).withColumn("page", slot % F.col("_pages")).drop("_pages").repartition(entity, "page")


def contributions(diff: DataFrame) -> DataFrame:
    """What each changed file takes from and gives to its (batch, sample).

    Dispatch is on the change type: an addition gives, a deletion takes, a modification does both.
    A pure move leaves content and membership as they are and contributes nothing.
    """
    gives = F.col("change_type").isin("added", "modified", "moved_modified")
    takes = F.col("change_type").isin("deleted", "modified", "moved_modified")

    def part(prefix, sign):
        return F.struct(
            F.lit(sign).alias("sign"), F.col(f"{prefix}_batch").alias("batch"),
            F.col(f"{prefix}_sample").alias("sample"), F.col(f"{prefix}_size").alias("size"),
            F.col(f"{prefix}_created").alias("created"), F.col(f"{prefix}_modified").alias("modified"),
            F.col(f"{prefix}_fingerprint").alias("fingerprint"),
        )

    parts = F.array_compact(F.array(F.when(takes, part("old", -1)), F.when(gives, part("new", 1))))
    return diff.filter(gives | takes).select(F.inline(parts))


def _deltas(diff):
    """The signed sum of the contributions per pair, and the ends of the time ranges they touch."""
    sign, gone, came = F.col("sign"), F.col("sign") < 0, F.col("sign") > 0
    signed = contributions(diff).select("*", *fingerprint_words(F.col("fingerprint"), sign))
    return signed.groupBy(*PAIR).agg(
        F.sum("sign").alias("_n"), F.count(F.when(gone, 1)).alias("_gone"), F.sum(F.col("size") * sign).alias("_size"),
        F.min(F.when(came, F.col("created"))).alias("_created"),
        F.max(F.when(came, F.col("modified"))).alias("_modified"),
        F.min(F.when(gone, F.col("created"))).alias("_gone_created"),
        F.max(F.when(gone, F.col("modified"))).alias("_gone_modified"),
        *[F.sum(w).alias(f"_{w}") for w in WORDS],
    )


def apply_deltas(pairs: DataFrame, diff: DataFrame, files, emptied: bool = False, touched: bool = False,
                 mark: str | None = None, kept=None) -> DataFrame:
    """The membership table after a diff, touching only pairs that changed.

    Counts, sizes and fingerprint words are exact under subtraction. A time range can only shrink
    when a removed file held one of its ends; those pairs alone are read again from ``files``, the
    listing after the change: a DataFrame, or a function from (batch, sample) rows to their files.
    A pair all of whose files are gone has the range of those that came.
    Pairs left without files disappear, or with ``emptied`` stay as rows without any.
    With ``touched`` only the pairs that changed come back; ``mark`` names a flag that tells them from others.
    ``kept`` stores a DataFrame that is read more than once.
    """
    lost_end = (F.col("_gone_created") <= F.col("created")) | (F.col("_gone_modified") >= F.col("modified"))
    replaced = F.coalesce(F.col("_gone") >= F.col("n_files"), F.lit(False))
    zero = F.lit(0).cast("bigint")
    joined = pairs.join(_deltas(diff), PAIR, "right" if touched else "full_outer")
    after = joined.select(
        *PAIR,
        (F.coalesce("n_files", zero) + F.coalesce("_n", zero)).alias("n_files"),
        (F.coalesce("size", zero) + F.coalesce("_size", zero)).alias("size"),
        F.when(replaced, F.col("_created")).otherwise(F.least("created", "_created")).alias("created"),
        F.when(replaced, F.col("_modified")).otherwise(F.greatest("modified", "_modified")).alias("modified"),
        *[(F.coalesce(w, zero) + F.coalesce(f"_{w}", zero)).alias(w) for w in WORDS],
        *([] if mark is None else [F.col("_n").isNotNull().alias(mark)]),
        F.coalesce(lost_end & ~replaced, F.lit(False)).alias("_stale"),
    )
    after = after if emptied else after.filter(F.col("n_files") > 0)
    if kept:
        after = kept(after, "after")
    stale = after.filter("_stale").select(*PAIR)
    if kept:
        stale = kept(stale, "stale")
    # A pair may own any share of the files: they are summed up in every task before they meet the stale pairs.
    ranges = (files(stale) if callable(files) else files).groupBy(*PAIR).agg(
        F.min("created").alias("_min_created"), F.max("modified").alias("_max_modified"))
    if not callable(files):
        ranges = ranges.join(stale, PAIR, "left_semi")

    def mended(rows):
        return rows.join(ranges, PAIR, "left").withColumns({
            "created": F.when(F.col("_stale"), F.col("_min_created")).otherwise(F.col("created")),
            "modified": F.when(F.col("_stale"), F.col("_max_modified")).otherwise(F.col("modified"))}).select(*after.columns)

    # Where it is stored, only the stale rows meet their ranges.
    after = after.filter(~F.col("_stale")).unionByName(kept(mended(after.filter("_stale")), "mended")) if kept else mended(after)
    return after.drop("_stale")


def affected(diff: DataFrame, key: str) -> DataFrame:
    """The batches or samples that some content change touches."""
    changed = diff.filter(~F.col("change_type").isin("unchanged", "moved"))
    names = F.array_distinct(F.array_compact(F.array(f"old_{key}", f"new_{key}")))
    return changed.select(F.explode(names).alias(key)).distinct()


def affected_files(files: DataFrame, diff: DataFrame, key: str) -> DataFrame:
    """All files of the touched batches or samples."""
    return files.join(affected(diff, key), key, "left_semi")


def affected_totals(files: DataFrame, diff: DataFrame, key: str) -> DataFrame:
    """Files and bytes of the touched batches or samples, summed up before they are selected."""
    totals = files.groupBy(key).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size"))
    return totals.join(affected(diff, key), key, "left_semi")


def mark_empty(entities: DataFrame, files: DataFrame, name: str, owner: str) -> DataFrame:
    """An entity none of whose files is left becomes deprecated."""
    owners = files.select(F.col(owner).alias(name)).distinct().withColumn("_owns", F.lit(True))
    status = F.when(F.col("_owns").isNull(), "deprecated").otherwise(F.col("status"))
    return entities.join(owners, name, "left").withColumn("status", status).drop("_owns")


def repeated_keys(rows: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once among the given rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def directory_rollup(files: DataFrame) -> DataFrame:
    """Per folder of source files: its own files and size, its parent, and its child folders' count."""
    own = files.groupBy("directory").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size"))
    own = own.withColumn("parent", F.regexp_replace("directory", "/[^/]*$", ""))
    children = own.groupBy(F.col("parent").alias("directory")).agg(F.count(F.lit(1)).alias("n_children"))
    return own.join(children, "directory", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))


def child_directories(directories: DataFrame) -> DataFrame:
    """Rows (directory, child) for folders that both hold source files."""
    child = directories.select(F.col("parent").alias("directory"), F.col("directory").alias("child"))
    return child.join(directories.select("directory"), "directory", "left_semi")


def hierarchy(pairs: DataFrame) -> DataFrame:
    """Totals per (sample, batch), per sample and overall, from the membership and not from every file."""
    return pairs.rollup("sample", "batch").agg(F.sum("n_files").alias("n_files"), F.sum("size").alias("size"))
