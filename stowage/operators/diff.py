"""Comparing a new listing with the previous catalog."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.fingerprints import file_fingerprint
from ..functions.paths import clean_path, has_identity, with_identity
from ..functions.predicates import active, any_of

# The properties whose change makes a new version of a file.
CONTENT_PROPERTIES = ("size", "dev", "ino", "modified")
CHANGE_TYPES = ("added", "deleted", "unchanged", "moved", "modified", "moved_modified")


def as_files(inventory: DataFrame, link_dir: str, keep=()) -> DataFrame:
    """Listed files as catalog rows: identity from the path, fingerprint from the stat fields.

    ``keep`` names columns of the inventory that come along.
    """
    listed = inventory.withColumn("filepath", clean_path(F.col("filepath")))
    return has_identity(with_identity(listed, link_dir)).select(
        "filepath", "symlink_dir", "name", "directory", "symlink", "extension", "basename",
        "batch", "sample", "size",
        F.col("ctime").cast("timestamp").alias("created"),
        F.col("mtime").cast("timestamp").alias("modified"),
        "dev", "ino", "nlink",
        F.lit("indexed").alias("status"),
        file_fingerprint(F.col("size"), F.col("dev"), F.col("ino"), F.col("mtime")).alias("fingerprint"), *keep,
    )


#: What of a file does not follow from the rest of it.
_GIVEN = ("symlink", "filepath", "size", "created", "modified", "dev", "ino", "nlink")


def listed_files(inventory: DataFrame, link_dir: str) -> DataFrame:
    """``one_per_link`` of the listed files, with what a pass needs; what follows from path and stat fields is made after the shuffle."""
    once = one_per_link(as_files(inventory, link_dir).select(*_GIVEN)).withColumnRenamed("symlink", "_link")
    return with_identity(once, link_dir).select(
        F.col("_link").alias("symlink"), *_GIVEN[1:], "batch", "sample",
        file_fingerprint(F.col("size"), F.col("dev"), F.col("ino"), F.col("modified")).alias("fingerprint"))


def unplaceable(inventory: DataFrame, link_dir: str) -> DataFrame:
    """Listed files whose path names no sample."""
    placed = with_identity(inventory.withColumn("filepath", clean_path(F.col("filepath"))), link_dir)
    return placed.filter(F.col("sample") == "").select("filepath")


def one_per_path(inventory: DataFrame, path: str = "filepath") -> DataFrame:
    """Each path once; duplicates collapse map-side, whichever roots or types listed them."""
    return inventory.dropDuplicates([path])


def one_per_link(files: DataFrame) -> DataFrame:
    """Each link once: of several files under one link name the smallest path stands.

    Of rows with that path the one modified last stands, and of those the least by all other columns.
    """
    rest = [c for c in files.columns if c not in ("symlink", "filepath")]
    age = [(-F.unix_micros("modified")).alias("_age")] if "modified" in rest else []
    first = F.min(F.struct("filepath", *age, *rest)).alias("_row")  # the order has the whole row, which so goes through the shuffle once
    return files.groupBy("symlink").agg(first).select("symlink", "_row.*").select(*files.columns)


def listing_only(current: DataFrame, previous: DataFrame, key: str = "symlink") -> DataFrame:
    return current.join(previous.select(key), key, "left_anti")


def catalog_only(current: DataFrame, previous: DataFrame, key: str = "symlink") -> DataFrame:
    return previous.join(current.select(key), key, "left_anti")


def in_both(current: DataFrame, previous: DataFrame, key: str = "symlink") -> DataFrame:
    return current.join(previous.select(key), key, "left_semi")


def snapshot_diff(current: DataFrame, previous: DataFrame, key: str = "symlink",
                  properties=CONTENT_PROPERTIES, carried=("batch", "sample", "created", "nlink")) -> DataFrame:
    """Classify every file of a listing and of the active catalog.

    Both sides hold one row per key. One shuffle per side; every later step - change log, affected
    batches, rollup deltas - reads the result and not the inputs again. For each of ``filepath``,
    ``fingerprint``, the properties and the carried columns there is an ``old_`` and a ``new_``.
    """
    columns = list(dict.fromkeys(["filepath", "fingerprint", *properties, *carried]))

    def side(df, prefix):
        return df.select(key, *[F.col(c).alias(f"{prefix}_{c}") for c in columns],
                         F.lit(True).alias(f"_{prefix}"))

    joined = side(current, "new").join(side(previous, "old"), key, "full_outer")
    listed, known = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    moved = listed & known & (F.col("new_filepath") != F.col("old_filepath"))
    modified = listed & known & ~F.col("new_fingerprint").eqNullSafe(F.col("old_fingerprint"))
    kind = (
        F.when(~known, "added").when(~listed, "deleted")
        .when(moved & modified, "moved_modified").when(modified, "modified")
        .when(moved, "moved").otherwise("unchanged")
    )
    both = listed & known
    return joined.select(
        key, kind.alias("change_type"),
        *[f"{p}_{c}" for c in columns for p in ("old", "new")],
        *[F.coalesce(f"new_{c}", f"old_{c}").alias(c) for c in carried if c in ("batch", "sample")],
        F.when(both, changes_array(properties)).alias("changed"),
    )


def changes_array(properties=CONTENT_PROPERTIES):
    """The properties that differ, as ``[{property, old, new}]``; the fingerprint pair comes last.

    Empty when nothing differs.
    """
    def entry(name):
        differs = ~F.col(f"old_{name}").eqNullSafe(F.col(f"new_{name}"))
        return F.when(differs, F.struct(
            F.lit(name).alias("property"),
            F.col(f"old_{name}").cast("string").alias("old"),
            F.col(f"new_{name}").cast("string").alias("new"),
        ))

    differ = [~F.col(f"old_{p}").eqNullSafe(F.col(f"new_{p}")) for p in properties]
    fingerprint = F.when(any_of(differ), F.struct(
        F.lit("fingerprint").alias("property"),
        F.col("old_fingerprint").alias("old"), F.col("new_fingerprint").alias("new"),
    ))
    return F.array_compact(F.array(*[entry(p) for p in properties], fingerprint))


def side_files(diff: DataFrame, side: str, key: str = "symlink") -> DataFrame:
    """The files of one side (``old`` or ``new``) of a diff, which has both completely."""
    columns = [c.removeprefix(f"{side}_") for c in diff.columns if c.startswith(f"{side}_")]
    return diff.filter(F.col(f"{side}_filepath").isNotNull()).select(
        key, *[F.col(f"{side}_{c}").alias(c) for c in columns])


def key_sides(current: DataFrame, previous: DataFrame, key: str = "symlink") -> DataFrame:
    """Every key once, with the side it is on: ``listing``, ``catalog`` or ``both``."""
    here = current.select(key).distinct().withColumn("_here", F.lit(True))
    there = previous.select(key).distinct().withColumn("_there", F.lit(True))
    side = F.when(F.col("_there").isNull(), "listing").when(F.col("_here").isNull(), "catalog").otherwise("both")
    return here.join(there, key, "full_outer").select(key, side.alias("side"))


def changed_files(diff: DataFrame) -> DataFrame:
    return diff.filter(F.col("change_type") != "unchanged")


def change_log(diff: DataFrame, key: str = "symlink") -> DataFrame:
    """One row per changed property of a kept file, keyed by sample, batch and file."""
    return diff.select("sample", "batch", key, F.explode("changed").alias("change")).select(
        "sample", "batch", key, "change.property", "change.old", "change.new")


def nested_changes(diff: DataFrame, key: str = "symlink") -> DataFrame:
    """The same log with one ``{property: {old, new}}`` map per file."""
    as_map = F.map_from_entries(F.transform(
        "changed", lambda c: F.struct(c["property"], F.struct(c["old"], c["new"]))))
    return diff.filter(F.size("changed") > 0).select("sample", "batch", key, as_map.alias("changes"))


def change_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change_type").agg(F.count(F.lit(1)).alias("n_files"))


def indexing_counts(diff: DataFrame) -> DataFrame:
    """How many files, batches and samples a pass touched."""
    changed = changed_files(diff)
    return changed.agg(
        F.count(F.lit(1)).alias("files"),
        F.countDistinct("batch").alias("batches"),
        F.countDistinct("sample").alias("samples"),
    )


def property_differences(old: DataFrame, new: DataFrame, key: str, properties) -> DataFrame:
    """Long rows of every property that differs between two versions of the same keys."""
    right = new.select(key, *[F.col(p).alias(f"new_{p}") for p in properties])
    left = old.select(key, *[F.col(p).alias(f"old_{p}") for p in properties])
    entries = F.array(*[
        F.struct(F.lit(p).alias("property"), F.col(f"old_{p}").cast("string").alias("old"),
                 F.col(f"new_{p}").cast("string").alias("new")) for p in properties])
    differing = F.filter(entries, lambda e: ~e["old"].eqNullSafe(e["new"]))
    return left.join(right, key).select(key, F.inline(differing))


def member_differences(old: DataFrame, new: DataFrame, entity: str, member: str) -> DataFrame:
    """Members gained and lost between two versions' long membership tables."""
    left, right = old.select(entity, member), new.select(entity, member)
    added = right.join(left, [entity, member], "left_anti").distinct().withColumn("difference", F.lit("added"))
    removed = left.join(right, [entity, member], "left_anti").distinct().withColumn("difference", F.lit("removed"))
    return added.unionByName(removed)


def active_files(catalog: DataFrame) -> DataFrame:
    """Catalog rows that stand for a file on disk; rows without a link are unusable."""
    return catalog.filter(active() & F.col("symlink").isNotNull())


def union_roots(*listings: DataFrame) -> DataFrame:
    """Listings of several roots as one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), listings)
