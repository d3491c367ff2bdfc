"""File events turned into the same kind of difference a listing gives.

An event carries the file's stat fields as they were when it was recorded. Events of a link fold to
one observation - is it there, where, with what content - by map-side aggregation, so a file that
changes all the time costs no more than any other.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.fingerprints import file_fingerprint
from ..functions.paths import sample_name, with_identity
from ..functions.predicates import active, matches_event_patterns
from ..session import written
from .diff import CONTENT_PROPERTIES, changes_array

_STAT = ["size", "dev", "ino", "nlink", "created", "modified"]


def watched(events: DataFrame, patterns) -> DataFrame:
    """Events on files of the wanted kinds; folders are ignored."""
    return events.filter(~F.coalesce("is_dir", F.lit(False)) & matches_event_patterns(F.col("src_path"), patterns))


def observations(events: DataFrame, link_dir: str) -> DataFrame:
    """One row per link named by the events: its last place, and the last content seen there.

    A move within one link name only changes the place. A move to another name makes the old link
    absent and the new one present, carrying on the old link's content: that which the events brought before the
    move, over any number of moves, or else that of the stored link ``from_link``. ``appeared`` tells
    whether the events ever showed the link present.
    """
    # A move without a destination is a loss of the source.
    kind = F.when((F.col("event_type") == "moved") & F.col("dest_path").isNull(), "deleted").otherwise(F.col("event_type"))
    here = with_identity(events.withColumn("event_type", kind), link_dir, "src_path").select(
        *events.columns, F.col("symlink").alias("_src_link"))
    there = with_identity(here, link_dir, "dest_path").withColumnRenamed("symlink", "_dest_link")
    renamed = (F.col("event_type") == "moved") & (F.col("_src_link") != F.col("_dest_link"))

    def entry(link, path, present, origin, left=False):
        return F.struct(link.alias("symlink"), path.alias("filepath"), present.alias("present"), origin.alias("from_link"), F.lit(left).alias("left"))

    nowhere, nobody = F.lit(None).cast("string"), F.lit(None).cast("string")
    source = entry(F.col("_src_link"), F.col("src_path"), ~F.col("event_type").isin("deleted", "moved"), nobody)
    target = entry(F.col("_dest_link"), F.col("dest_path"), F.lit(True), F.when(renamed, F.col("_src_link")))
    parts = F.when(F.col("event_type") != "moved", F.array(source)).when(renamed, F.array(
        entry(F.col("_src_link"), nowhere, F.lit(False), nobody, left=True), target)).otherwise(F.array(target))
    stat = F.struct("size", "dev", "ino", "nlink", F.col("ctime").alias("created"), F.col("mtime").alias("modified"))
    seen = there.select("ts", F.when(F.col("size").isNotNull(), stat).alias("stat"), F.inline(parts))
    # What a link holds comes from the last event that brought content, or from the link it was renamed from then.
    brings = F.col("stat").isNotNull() | F.col("from_link").isNotNull()
    content = F.struct("ts", "stat", "from_link")
    folded = written(seen.groupBy("symlink").agg(
        F.max(F.struct("ts", "present", "filepath")).alias("last"),
        F.max_by(content, F.when(brings, F.struct("ts", F.col("stat").isNotNull()))).alias("content"),
        F.max("ts").alias("ts"), F.max("present").alias("appeared"), F.max("left").alias("left"),
    ), "folded")
    columns = ["symlink", "ts", "last.present", "last.filepath", "appeared"]
    # A link that is gone in the end has no content, wherever it had come from.
    asks = F.coalesce(F.col("last.present") & F.col("content.from_link").isNotNull() & F.col("content.stat").isNull(), F.lit(False))
    settled = folded.filter(~asks).select(
        *columns, F.lit(None).cast("string").alias("from_link"), F.when(F.col("last.present"), F.col("content.stat")).alias("stat"))
    moved = folded.filter(asks)
    origin = _origins(moved.select("symlink", F.col("content.ts").alias("at"), "content.from_link"), folded, seen.filter(brings))
    moved = written(moved.select(*columns).join(origin, "symlink"), "renamed")
    return settled.unionByName(moved).select(
        *[c for c in settled.columns if c != "stat"], *[F.col(f"stat.{c}").alias(c) for c in _STAT])


def _origins(renamed, folded, contents):
    """For each renamed link (``symlink``, ``at``, ``from_link``) the content its file had before the move.

    ``stat`` where the events brought it, else ``from_link``, the stored link at the beginning of the chain of moves.
    Only renamed rows take part; each hop goes back in time, so the hops end. A hop looks at the last content of links that
    files were renamed from, and at their events only where that content came after the move.
    """
    newest = folded.filter("left and content is not null").select(F.col("symlink").alias("from_link"), F.col("content").alias("c"))
    earlier = contents.select(F.col("symlink").alias("from_link"), F.struct("ts", "stat", F.col("from_link")).alias("_c"))

    def before(c):
        # Of two events at one time the one that brings content came first.
        return F.coalesce((F.col(f"{c}.ts") < F.col("at")) | ((F.col(f"{c}.ts") == F.col("at")) & F.col(f"{c}.stat").isNotNull()), F.lit(False))

    done, open_ = [renamed.limit(0).select("symlink", "from_link", F.lit(None).cast(contents.schema["stat"].dataType).alias("stat"))], renamed
    while not open_.isEmpty():
        hop = written(open_.join(newest, "from_link", "left"), "hops")
        late = F.col("c").isNotNull() & ~before("c")
        if not hop.filter(late).isEmpty():
            asked = hop.filter(late).drop("c")
            last = asked.join(earlier, "from_link").filter(before("_c")).groupBy("symlink").agg(
                F.max_by("_c", F.struct("_c.ts", F.col("_c.stat").isNotNull())).alias("c"))
            hop = hop.filter(~late).unionByName(written(asked.join(last, "symlink", "left").select(*hop.columns), "late-hops"))
        done.append(hop.filter("c is null or c.stat is not null").select(
            "symlink", F.when(F.col("c").isNull(), F.col("from_link")).alias("from_link"), F.col("c.stat").alias("stat")))
        open_ = hop.filter("c.stat is null and c.from_link is not null").select(
            "symlink", F.col("c.ts").alias("at"), F.col("c.from_link").alias("from_link"))
    return reduce(DataFrame.unionByName, done)


def placeable(events: DataFrame, link_dir: str) -> DataFrame:
    """Events on paths that name a sample; a move keeps the end that does, as a deletion or a creation."""
    deep = {side: F.coalesce(sample_name(F.col(side)) != "", F.lit(False)) for side in ("src_path", "dest_path")}
    moved = (F.col("event_type") == "moved") & F.col("dest_path").isNotNull()
    kept = events.filter(deep["src_path"] | (moved & deep["dest_path"]))
    arrived, left = moved & ~deep["src_path"], moved & ~deep["dest_path"]
    return kept.withColumns({
        "event_type": F.when(arrived, "created").when(left, "deleted").otherwise(F.col("event_type")),
        "src_path": F.when(arrived, F.col("dest_path")).otherwise(F.col("src_path")),
        "dest_path": F.when(arrived | left, F.lit(None)).otherwise(F.col("dest_path"))})


def event_diff(events: DataFrame, catalog: DataFrame, link_dir: str) -> DataFrame:
    """Classify events against the catalog's active files, in the shape of a listing diff.

    A link that the same events made and took away again, and the catalog lacks, is no change.

    A modification of an unknown file is an addition. A deletion of an unknown file is
    ``unknown_deleted``, to be reported and not applied. A known link found at another place with
    other content is ``moved_modified``.
    """
    return observed_diff(observations(events, link_dir), catalog, link_dir)


def observed_diff(seen: DataFrame, catalog: DataFrame, link_dir: str, carried=()) -> DataFrame:
    """The same for events already folded to observations; ``carried`` names further columns of the catalog, each wanted as ``old_``."""
    live = catalog.filter(active())
    known = live.select(
        "symlink", F.lit(True).alias("_known"), F.col("filepath").alias("old_filepath"),
        *[F.col(c).alias(f"old_{c}") for c in ("fingerprint", *_STAT, "batch", "sample", *carried)])
    # Content of a renamed file comes from its old link, unless an event brought it.
    origin = live.select(F.col("symlink").alias("from_link"), F.struct(*_STAT).alias("_origin"))
    joined = seen.join(known, "symlink", "left")
    # Few rows were renamed; the others stay out of that join, and so do their null keys.
    renamed = joined.filter("from_link is not null").join(origin, "from_link", "left")
    joined = joined.filter("from_link is null").unionByName(renamed, allowMissingColumns=True)
    present = F.col("present")
    content = joined.withColumns({
        f"new_{c}": F.when(present, F.coalesce(c, f"_origin.{c}", f"old_{c}")) for c in _STAT
    }).withColumn("new_filepath", F.when(present, F.col("filepath")))
    kept = [c for c in content.columns if c != "symlink"]
    placed = with_identity(content.withColumnRenamed("symlink", "_link"), link_dir, "new_filepath").select(
        *kept, F.col("_link").alias("symlink"),
        F.when(present, F.col("batch")).alias("new_batch"), F.when(present, F.col("sample")).alias("new_sample"))
    fingerprint = file_fingerprint(F.col("new_size"), F.col("new_dev"), F.col("new_ino"), F.col("new_modified"))
    printed = placed.withColumn("new_fingerprint", F.when(present, fingerprint))
    stored = F.col("_known").isNotNull()
    moved = F.col("new_filepath") != F.col("old_filepath")
    modified = ~F.col("new_fingerprint").eqNullSafe(F.col("old_fingerprint"))
    change = (
        F.when(present & ~stored, "added").when(~present & ~stored, "unknown_deleted").when(~present, "deleted")
        .when(moved & modified, "moved_modified").when(modified, "modified").when(moved, "moved").otherwise("unchanged")
    )
    both = [f"{p}_{c}" for c in ("filepath", "fingerprint", *CONTENT_PROPERTIES, "batch", "sample", "created", "nlink")
            for p in ("old", "new")]
    passing = ~present & ~stored & F.col("appeared")
    return printed.filter(~passing).select(
        "symlink", change.alias("change_type"), *both, *[f"old_{c}" for c in carried], "ts",
        F.coalesce("new_batch", "old_batch").alias("batch"), F.coalesce("new_sample", "old_sample").alias("sample"),
        F.when(stored & present, changes_array()).alias("changed"))


def rejected(diff: DataFrame) -> DataFrame:
    """Deletions of files the catalog does not know."""
    return diff.filter("change_type = 'unknown_deleted'").select("symlink", "ts", F.lit("deleted, not in catalog").alias("reason"))


def applicable(diff: DataFrame) -> DataFrame:
    return diff.filter(~F.col("change_type").isin("unknown_deleted", "unchanged"))


def report_set(events: DataFrame) -> DataFrame:
    """Report files that exist after the events: the last event per path decides.

    A move takes the file away at one path and adds it at the other.
    """
    gone = F.col("event_type").isin("deleted", "moved")
    parts = F.array_compact(F.array(
        F.struct(F.col("src_path").alias("filepath"), (~gone).alias("present")),
        F.when(F.col("event_type") == "moved", F.struct(F.col("dest_path").alias("filepath"), F.lit(True).alias("present")))))
    rows = events.select("ts", F.inline(parts)).filter("filepath is not null")
    last = rows.groupBy("filepath").agg(F.max_by("present", F.struct("ts", "present")).alias("present"))
    return last.filter("present").select("filepath")
