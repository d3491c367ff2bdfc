"""Bringing a stored catalog up to date.

A pass reads the catalog as of the pass before it and appends its rows to each table, ``passes`` last. A pass that
is run again reads the same state and writes the same rows, so a pass interrupted anywhere is simply repeated.
``files``, ``membership`` and ``batches`` lie in buckets of the batch, ``samples`` and ``sample_membership`` (the same
rows as ``membership``) in buckets of the sample: a pass opens the buckets that its changes fall in.

Tables (keys): ``files`` (row_id), ``membership`` (batch, sample), ``batches`` (row_id),
``samples`` (row_id), ``changes``, ``rejects``, ``passes``. A ``row_id`` names one version of an
entity: its key and the pass it was born in.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.fingerprints import WORDS, file_fingerprint
from ..functions.paths import REPORT_TYPES, entity_dir, sample_id, with_identity
from ..functions.predicates import active
from ..operators import diff as D, events as E, rollup as R, versions as V
from ..operators.reports import batch_reports
from ..session import fixed, intermediates, written
from ..sources import tables
from .curation import Curation, by_batch as _by_batch, read_held, review

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()


def _schema(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


FILES = _schema(
    row_id=_S, born=_L, symlink=_S, filepath=_S, name=_S, directory=_S, basename=_S, extension=_S, batch=_S,
    sample=_S, size=_L, created=_TS, modified=_TS, dev=_L, ino=_L, nlink=_L, status=_S, previous_version=_S,
    next_version=_S, fingerprint=_S, deleted_at=_TS, updated_at_DB=_TS)
MEMBERSHIP = _schema(
    batch=_S, sample=_S, n_files=_L, size=_L, created=_TS, modified=_TS, **{w: _L for w in WORDS})
BATCHES = _schema(
    row_id=_S, born=_L, batch=_S, n_samples=_L, n_files=_L, size=_L, created=_TS, modified=_TS, fingerprint=_S,
    status=_S, previous_version=_S, next_version=_S, final_summary=_S, sequencing_summary=_S, updated_at_DB=_TS)
SAMPLES = _schema(
    row_id=_S, born=_L, sample=_S, n_batches=_L, n_files=_L, size=_L, created=_TS, modified=_TS, fingerprint=_S,
    sample_id=_S, processing_dir=_S, result_dir=_S, status=_S, previous_version=_S, next_version=_S,
    updated_at_DB=_TS)
CHANGES = _schema(sample=_S, batch=_S, symlink=_S, property=_S, old=_S, new=_S, version=_L)
REJECTS = _schema(symlink=_S, ts=_TS, reason=_S)
PASSES = _schema(files=_L, batches=_L, samples=_L)
PAIR = ["batch", "sample"]


def _by_link(link="symlink") -> Column:
    """The bucket of a file: that of its batch, which its link begins with."""
    return _by_batch(F.substring_index(link, "/", -1))


def _by_sample(sample="sample") -> Column:
    return tables.bucket(sample)


#: Schema, key and bucket of the tables that are folded to the newest row of a key.
FOLDED = {
    "files": (FILES, "row_id", _by_link), "membership": (MEMBERSHIP, PAIR, _by_batch),
    "sample_membership": (MEMBERSHIP, PAIR, _by_sample), "batches": (BATCHES, "row_id", _by_batch), "samples": (SAMPLES, "row_id", _by_sample)}


def committed(spark: SparkSession, root: str) -> int:
    """The newest finished pass, or -1."""
    return tables.latest_version(spark, root, "passes")


def _read(spark, root, table, upto=None, **options) -> DataFrame:
    schema, key, _ = FOLDED[table]
    return tables.read_live(spark, root, table, schema, key, upto, standing=F.lit(True), **options)


def _append(df, root, table, version) -> None:
    schema, _, place = FOLDED[table]
    tables.append_rows(_fit(df, schema), root, table, version, place())


def read_files(spark, root, upto=None, columns=None) -> DataFrame:
    """Every version of every file; ``columns`` prunes the fold."""
    rows = _read(spark, root, "files", upto, columns=None if columns is None else list(dict.fromkeys(["row_id", *columns])))
    return rows if columns is None else rows.select(*columns)


def read_membership(spark, root, upto=None, only=None, buckets=None) -> DataFrame:
    return _read(spark, root, "membership", upto, only=only, buckets=buckets).filter("n_files > 0")


def read_batches(spark, root, upto=None) -> DataFrame:
    return _read(spark, root, "batches", upto)


def read_samples(spark, root, upto=None) -> DataFrame:
    return _read(spark, root, "samples", upto)


def read_rejects(spark, root, upto=None) -> DataFrame:
    """What passes set aside: paths that name no sample, deletions of unknown files."""
    return tables.read_rows(spark, root, "rejects", REJECTS, upto).drop("as_of")


def read_pass(spark, root, version) -> DataFrame:
    """How many files, batches and samples a finished pass touched."""
    return tables.read_finished(spark, root, "passes", PASSES, version)


def compact(spark, root, passes: int = 1) -> None:
    """Fold what buckets hold of more than so many passes, up to the newest finished one. Earlier passes cannot be read or repeated afterwards."""
    upto = committed(spark, root)
    with intermediates(spark):
        for table, (schema, key, place) in FOLDED.items():
            tables.compact(spark, root, table, schema, key, upto, passes, place())


def _current(spark, root, table, key, upto, only=None, columns=None, buckets=None):
    """The active version per key, found by folding on the key itself: one shuffle, kept for joins. Of folded rows a key has one at most."""
    return tables.read_live(spark, root, table, FOLDED[table][0], key, upto, only, columns, order=("born",), buckets=buckets, standing=active())


def current_files(spark, root, upto=None, only=None, columns=None, buckets=None) -> DataFrame:
    return _current(spark, root, "files", "symlink", upto, only, columns, buckets)


def current_batches(spark, root, upto=None, only=None, buckets=None) -> DataFrame:
    return _current(spark, root, "batches", "batch", upto, only, None, buckets)


def current_samples(spark, root, upto=None, only=None, buckets=None) -> DataFrame:
    return _current(spark, root, "samples", "sample", upto, only, None, buckets)


#: Of a stored file what its old row takes along; the rest of that row follows from the difference.
_KEPT = ("born", "status", "previous_version")
_COMPARED = ["symlink", *_KEPT, "filepath", "size", "dev", "ino", "nlink", "created",
             "modified", "batch", "sample"]


def sync_listing(spark: SparkSession, root: str, inventory: DataFrame, link_dir: str, now: Column,
                 version: int | None = None, **options) -> int:
    """Index a full listing; what the catalog has and the listing lacks is deleted.

    Listing and catalog each shuffle once, by link; equal paths have equal links, so duplicates of
    a path collapse in the same fold. Files whose path names no sample go to the rejects table.
    ``compact_after`` folds the tables after every so many passes. With ``curation``, batches that wait count for no sample;
    it is given to every pass of a catalog or to none.
    """
    version = committed(spark, root) + 1 if version is None else version
    now = fixed(spark, now)
    with intermediates(spark):
        shallow = D.unplaceable(inventory, link_dir).select(F.col("filepath").alias("symlink"), now.alias("ts"), F.lit(
            "path names no sample").alias("reason"))
        tables.append_rows(_fit(shallow, REJECTS), root, "rejects", version)
        files = D.listed_files(inventory, link_dir).withColumns({c: F.lit(None).cast(FILES[c].dataType) for c in _KEPT})
        stored = _printed(current_files(spark, root, version - 1, columns=_COMPARED))
        found = D.snapshot_diff(files, stored, carried=("batch", "sample", "created", "nlink", *_KEPT))
        # Every table below is derived from the changes alone, so they are computed once.
        changed = written(D.changed_files(found).select(*_DIFF), "changes")
        return _write_pass(spark, root, version, changed, link_dir, now, **options)


def sync_events(spark: SparkSession, root: str, events: DataFrame, link_dir: str, now: Column,
                version: int | None = None, **options) -> int:
    """Index a batch of file events; unknown deletions and paths that name no sample go to the rejects table.

    Only the buckets of the links that the events name are opened.
    """
    version = committed(spark, root) + 1 if version is None else version
    now = fixed(spark, now)
    with intermediates(spark):
        shallow = events.select(F.explode(F.array_compact(F.array("src_path", "dest_path"))).alias("filepath"), "ts")
        lost = with_identity(shallow, link_dir).filter("sample = ''").groupBy(F.col("filepath").alias("symlink")).agg(
            F.max("ts").alias("ts")).withColumn("reason", F.lit("path names no sample"))
        placed = E.placeable(events, link_dir)
        seen = E.observations(placed, link_dir)
        links = seen.select("symlink").union(seen.select("from_link")).filter("symlink is not null")
        at = tables.buckets_of(links, files=_by_link())
        stored = _printed(current_files(spark, root, version - 1, only=links.distinct(), columns=_COMPARED, buckets=at["files"]))
        found = written(E.observed_diff(seen, stored, link_dir, _KEPT).select(*_DIFF, "ts"), "event-diff")
        tables.append_rows(_fit(E.rejected(found), REJECTS).unionByName(_fit(lost, REJECTS)), root, "rejects", version)
        return _write_pass(spark, root, version, E.applicable(found), link_dir, now, **options)


def _write_pass(spark, root, version, changed, link_dir, now, reports=None,
                processing_dir="/processing", result_dir="/results", compact_after=None, curation: Curation | None = None):
    before = version - 1
    at = _touched(changed)
    tables.append_rows(_file_rows(changed, link_dir, version, now), root, "files", version)
    tables.append_rows(D.change_log(changed).withColumn("version", F.lit(version).cast("bigint")),
                       root, "changes", version)

    def files_of(some_pairs):
        columns = ["symlink", "born", "status", *PAIR, "created", "modified"]
        return current_files(spark, root, version, only=some_pairs, columns=columns, buckets=at["batch"])

    wide = _wide(spark, root, changed, before)
    if wide:  # all pairs as they are after the pass, so that nothing below has to fold them again
        mine = read_membership(spark, root, before)
        after = R.apply_deltas(mine, changed, files_of, emptied=True, mark="touched", kept=written if version else None)
        after = after if version else written(after, "pairs")
        pairs = after.filter("touched")
    else:
        touched = R.contributions(changed).select(*PAIR).distinct()
        mine = read_membership(spark, root, before, only=touched, buckets=at["batch"])
        pairs = written(_fit(R.apply_deltas(mine, changed, files_of, emptied=True, touched=True), MEMBERSHIP), "pairs")
    for table in ("membership", "sample_membership"):  # the same rows, to be found by batch and by sample
        _append(pairs, root, table, version)

    born = F.lit(version).cast("bigint")
    names = {key: pairs.select(key).distinct() for key in PAIR}
    rolled = R.batch_rollup(after.filter("n_files > 0") if wide else read_membership(
        spark, root, version, only=names["batch"], buckets=at["batch"]))
    current = current_batches(spark, root, before, names["batch"], at["batch"])
    batches = _fit(V.version_rows(current, rolled.join(names["batch"], "batch", "left_semi") if wide else rolled, "batch", born, now), BATCHES)
    if reports is not None:
        batches = written(batches, "batches")
    batches = _with_reports(batches, current, None if reports is None else current_batches(spark, root, before), reports,
                            version, now)
    _append(batches, root, "batches", version)

    if curation:
        flipped = review(spark, root, version, names["batch"], lambda some, buckets: current_batches(
            spark, root, version, some, buckets), curation, now)
    # A sample's dates come from its whole batches.
    if wide:  # every sample is rolled up; those that come out as they were give no rows
        pairs, wanted, named = after.filter("n_files > 0"), None, None
    else:
        named = names["sample"]
        if curation:
            there = tables.buckets_of(flipped, at=_by_batch())["at"]
            others = read_membership(spark, root, version, flipped, there).select("sample")
            named = written(named.union(others).distinct(), "samples-named")
            at["sample"] = tables.buckets_of(named, at=_by_sample())["at"]
        pairs = written(_read(spark, root, "sample_membership", version, only=named, buckets=at["sample"]).filter("n_files > 0"), "sample-pairs")
        wanted = tables.buckets_of(pairs, batch=_by_batch())["batch"]
    if curation:
        pairs = pairs.join(read_held(spark, root, version, wanted).select("batch"), "batch", "left_anti")
    dates = current_batches(spark, root, version, None if wide else pairs.select("batch").distinct(), wanted)
    current = current_samples(spark, root, before, named, None if wide else at["sample"])
    samples = V.version_rows(current, R.dated_sample_rollup(pairs, dates), "sample", born, now)
    samples = samples.withColumns({
        "sample_id": sample_id(F.col("sample"), F.col("fingerprint")),
        "processing_dir": entity_dir(F.lit(processing_dir), F.col("sample"), F.col("fingerprint")),
        "result_dir": entity_dir(F.lit(result_dir), F.col("sample"), F.col("fingerprint"))})
    _append(samples, root, "samples", version)
    tables.finish(D.indexing_counts(changed), root, "passes", version)
    if compact_after and (version + 1) % compact_after == 0:
        compact(spark, root)
    return version


def _touched(changed) -> dict[str, list[int]]:
    """The buckets that changes fall in, by batch and by sample."""
    def of(place, *columns):
        return [F.when(F.col(c).isNotNull(), place(c)) for c in columns]

    found = tables.buckets_of(changed, **{f"b{k}": x for k, x in enumerate([_by_link(), *of(_by_batch, "old_batch", "new_batch")])},
                              **{f"s{k}": x for k, x in enumerate(of(_by_sample, "old_sample", "new_sample"))})
    return {name: sorted(set().union(*(v for k, v in found.items() if k[0] == name[0]))) for name in ("batch", "sample")}


_DIFF = ["symlink", "change_type", "changed", "batch", "sample"] + [
    f"{p}_{c}" for p in ("old", "new")
    for c in ("filepath", "fingerprint", "size", "dev", "ino", "modified", "created", "nlink", "batch", "sample")] + [
    f"old_{c}" for c in _KEPT]


def _printed(files, side=""):
    """Files with their fingerprints, which follow from the stat fields and so need not go through a shuffle."""
    return files.withColumn(f"{side}fingerprint", file_fingerprint(*[F.col(f"{side}{c}") for c in ("size", "dev", "ino", "modified")]))


def _wide(spark, root, changed, before) -> bool:
    """Whether a pass changes so much that choosing what it touches costs more than reading its buckets whole; by file footers."""
    return 4 * changed.count() > tables.read_rows(spark, root, "membership", MEMBERSHIP, before).count()


def _fit(df, schema):
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def _file_rows(changed, link_dir, version, now):
    """New versions and additions, and the touched old rows: deprecated, deleted or moved; with their bucket.

    An active row has no next version and was not deleted, and its names follow from its path: changes tell all of it. They are
    dealt to buckets as they are, and the rows made there.
    """
    born = F.lit(version).cast("bigint")
    stat = ("size", "created", "modified", "dev", "ino", "nlink", "batch", "sample")
    own = {p: [f"{p}_{c}" for c in ("filepath", *stat)] for p in ("old", "new")}
    rows = tables.dealt(changed.select("symlink", "change_type", *own["old"], *own["new"], *[f"old_{c}" for c in _KEPT]), _by_link())
    rows = _printed(_printed(rows, "old_"), "new_")

    def side(prefix):
        return [F.col(f"{prefix}_{c}").alias(c) for c in ("filepath", *stat, "fingerprint")]

    arrives, known = F.col("change_type").isin("added", "modified", "moved_modified"), F.col("change_type") != "added"
    gone, moved = F.col("change_type") == "deleted", F.col("change_type") == "moved"
    new = F.struct(
        "symlink", born.alias("born"), *side("new"), F.lit("indexed").alias("status"), F.when(known, F.col("old_fingerprint")).otherwise("").alias("previous_version"),
        F.lit(None).cast("string").alias("next_version"), F.lit(None).cast("timestamp").alias("deleted_at"), F.lit(None).cast("string").alias("_moved"))
    old = F.struct(
        "symlink", F.col("old_born").alias("born"), *side("old"),
        F.when(gone, "deleted").when(moved, F.col("old_status")).otherwise("deprecated").alias("status"),
        F.col("old_previous_version").alias("previous_version"),
        F.when(~(gone | moved), F.col("new_fingerprint")).alias("next_version"), F.when(gone, now).alias("deleted_at"),
        F.when(moved, F.col("new_filepath")).alias("_moved"))
    both = rows.select("in_bucket", F.inline(F.array_compact(F.array(F.when(arrives, new), F.when(known, old)))))
    named = with_identity(both.withColumnsRenamed({"symlink": "_link", "batch": "_batch", "sample": "_sample"}), link_dir).withColumns({
        "symlink": F.col("_link"), "batch": F.col("_batch"), "sample": F.col("_sample")})
    placed = named.withColumns({
        "row_id": F.concat_ws("@", "symlink", "born"), "updated_at_DB": now, "filepath": F.coalesce("_moved", "filepath"),
        "directory": F.when(F.col("_moved").isNull(), F.col("directory")).otherwise(F.regexp_replace("_moved", "/[^/]*$", ""))})
    return placed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FILES], "in_bucket")


def _with_reports(batches, current, every, reports, version, now):
    """The batch rows of a pass with their report files.

    A new version keeps the reports of the version it replaces. With ``reports``, those it lacks are looked up, and so
    are those that any other batch lacks: a batch that finds one is written again, as the version it is.
    """
    new = batches.filter(F.col("born") == version)
    kept = current.select("batch", *[F.col(k).alias(f"_{k}") for k in REPORT_TYPES])
    carried = new.join(kept, "batch", "left").withColumns({
        k: F.coalesce(k, f"_{k}") for k in REPORT_TYPES}).drop(*[f"_{k}" for k in REPORT_TYPES])
    old = batches.filter(F.col("born") != version)
    if every is None:
        return carried.unionByName(old)
    lacking = F.lit(False)
    for k in REPORT_TYPES:
        lacking = lacking | F.col(k).isNull()
    others = every.join(batches.select("batch").distinct(), "batch", "left_anti").filter(lacking)
    asked = carried.withColumn("_others", F.lit(False)).unionByName(
        _fit(others, BATCHES).withColumn("_others", F.lit(True)))
    found = batch_reports(asked.select("batch"), reports).select("batch", *[F.col(k).alias(f"_{k}") for k in REPORT_TYPES])
    joined = asked.join(found, "batch")
    gained = F.lit(False)
    for k in REPORT_TYPES:
        gained = gained | (F.col(k).isNull() & F.col(f"_{k}").isNotNull())
    filled = joined.filter(~F.col("_others") | gained).withColumns({
        "updated_at_DB": F.when(F.col("_others"), now).otherwise(F.col("updated_at_DB")),
        **{k: F.coalesce(k, f"_{k}") for k in REPORT_TYPES}})
    return _fit(filled, BATCHES).unionByName(old)
