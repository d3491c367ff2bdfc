"""Entity versions, and row-level changes expressed as a new snapshot.

Nothing is changed in place: an operator takes the table as it is and returns the table as it
should be. ``now`` is always an argument.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.predicates import active
from ..functions.paths import basename, directory, file_name, with_identity
from .ordered import DAY, with_neighbours

# Names of the audit columns.
INSERTED_AT, UPDATED_AT = "created_at_DB", "updated_at_DB"


def version_chain(rows: DataFrame, key: str, order: str, fingerprint: str = "fingerprint",
                  bucket_seconds: int = 30 * DAY) -> DataFrame:
    """Add ``previous_version`` and ``next_version``: the neighbours' fingerprints of the same key."""
    chained = with_neighbours(rows, [key], order, [fingerprint], before="_back",
                              after="_ahead", tie=[fingerprint], bucket_seconds=bucket_seconds)
    return chained.withColumns({
        "previous_version": F.col("_back")[fingerprint], "next_version": F.col("_ahead")[fingerprint],
    }).drop("_back", "_ahead")


def live(rows: DataFrame, key, *order: str) -> DataFrame:
    """The newest row per key; keys collapse map-side, so a much-versioned key is no hot spot."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*rows.columns)


def changes_between_versions(rows: DataFrame, key: str, order: str, properties, tie=("fingerprint",),
                             bucket_seconds: int = 30 * DAY) -> DataFrame:
    """Long rows of what each version changed against the one before it; ``tie`` orders versions of one time."""
    near = with_neighbours(rows, [key], order, [F.col(p) for p in properties], before="_before",
                           tie=list(tie), bucket_seconds=bucket_seconds)
    entries = F.array(*[
        F.struct(F.lit(p).alias("property"), F.col(f"_before.{p}").cast("string").alias("old"),
                 F.col(p).cast("string").alias("new")) for p in properties])
    differing = F.filter(entries, lambda e: ~e["old"].eqNullSafe(e["new"]))
    return near.filter(F.col("_before").isNotNull()).select(key, order, F.inline(differing))


def _marked(rows, keys, flag):
    return rows.select(*keys).distinct().withColumn(flag, F.lit(True))


def supersede(base: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """Deprecate the rows that some new row names as its previous version."""
    replaced = new.filter(F.coalesce("previous_version", F.lit("")) != "").select(
        F.col("previous_version").alias("fingerprint"))
    flagged = base.join(_marked(replaced, ["fingerprint"], "_old"), "fingerprint", "left")
    hit = F.col("_old").isNotNull()
    return _stamped(flagged.withColumn(
        "status", F.when(hit, "deprecated").otherwise(F.col("status"))), hit, now).drop("_old").select(
            *_with_audit(base, now))


def _with_audit(base, now):
    extra = [UPDATED_AT] if now is not None and UPDATED_AT not in base.columns else []
    return [*base.columns, *extra]


def _stamped(df, hit, now):
    if now is None:
        return df
    old = F.col(UPDATED_AT) if UPDATED_AT in df.columns else F.lit(None).cast("timestamp")
    return df.withColumn(UPDATED_AT, F.when(hit, now).otherwise(old))


def with_audit(rows: DataFrame, now: Column, inserting: bool) -> DataFrame:
    """Stamp rows on write; a time the row already brings is kept."""
    names = [UPDATED_AT, INSERTED_AT] if inserting else [UPDATED_AT]
    return rows.withColumns({
        n: F.coalesce(F.col(n), now) if n in rows.columns else now for n in names})


def merge_snapshot(base: DataFrame, changes: DataFrame, key, now: Column, mode: str = "upsert") -> DataFrame:
    """The table after ``changes`` (one row per key) are applied to it.

    ``upsert``  set the columns the changes bring, insert keys the table lacks
    ``update``  the same without inserting
    ``delete``  drop the keys named by the changes
    ``append``  add the rows as new ones
    An update stamps ``updated_at_DB`` unless the change brings one; only an insert stamps
    ``created_at_DB``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if mode == "delete":
        return base.join(changes.select(*keys), keys, "left_anti")
    if mode == "append":
        return base.unionByName(with_audit(changes, now, inserting=True), allowMissingColumns=True)
    if mode not in ("upsert", "update"):
        raise ValueError(f"unknown merge mode: {mode}")

    brought = [c for c in changes.columns if c not in keys]
    right = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in brought], F.lit(True).alias("_hit"))
    left = base.withColumn("_there", F.lit(True))
    joined = left.join(right, keys, "full_outer" if mode == "upsert" else "left")
    hit, inserted = F.col("_hit").isNotNull(), F.col("_there").isNull()

    def value(name):
        old = F.col(name) if name in base.columns else F.lit(None)
        new = F.col(f"_new_{name}") if name in brought else None
        if name == UPDATED_AT:
            stamp = now if new is None else F.coalesce(new, now)
            return F.when(hit, stamp).otherwise(old)
        if name == INSERTED_AT:
            stamp = now if new is None else F.coalesce(new, now)
            return F.when(inserted, stamp).otherwise(old)
        return old if new is None else F.when(hit, new).otherwise(old)

    names = list(dict.fromkeys([*base.columns, *changes.columns, UPDATED_AT, INSERTED_AT]))
    return joined.select(*[F.col(n) if n in keys else value(n).alias(n) for n in names])


def match_counts(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Changes that do not meet exactly one row of the table, with the number they meet."""
    there = base.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    met = changes.select(key).distinct().join(there, key, "left")
    return met.select(key, F.coalesce("n", F.lit(0).cast("bigint")).alias("matched")).filter("matched != 1")


def update_where(base: DataFrame, predicate: Column, values: dict[str, Column], now: Column) -> DataFrame:
    """Set columns on every row that satisfies the predicate."""
    hit = F.coalesce(predicate, F.lit(False))
    old = {c: F.col(c) if c in base.columns else F.lit(None) for c in [*values, UPDATED_AT]}
    new = {**values, UPDATED_AT: values.get(UPDATED_AT, now)}
    return base.withColumns({c: F.when(hit, v).otherwise(old[c]) for c, v in new.items()})


def soft_delete(base: DataFrame, gone: DataFrame, now: Column, key: str = "symlink") -> DataFrame:
    """Mark the active rows of the given keys as deleted."""
    flagged = base.join(_marked(gone, [key], "_gone"), key, "left")
    hit = F.col("_gone").isNotNull() & active()
    marked = update_where(flagged, hit, {"status": F.lit("deleted"), "deleted_at": now}, now)
    return marked.drop("_gone")


def move_files(base: DataFrame, moves: DataFrame, now: Column, link_dir: str | None = None) -> DataFrame:
    """Give active rows the path their link now points to: ``moves`` is (symlink, new_filepath).

    With ``link_dir`` a move may also change the names: link, type, batch and sample follow from the new path, as
    far as the table has those columns.
    """
    if link_dir is not None:
        placed = with_identity(moves.select("symlink", "new_filepath").withColumnRenamed("symlink", "_link"), link_dir, "new_filepath")
        names = [c for c in ("symlink", "symlink_dir", "name", "directory", "basename", "extension", "batch", "sample")
                 if c in base.columns]
        known = placed.select(F.col("_link"), "new_filepath", *[F.col(c).alias(f"_new_{c}") for c in names])
        flagged = base.join(known, F.col("symlink") == F.col("_link"), "left")
        hit = F.col("_link").isNotNull() & active()
        values = {"filepath": F.col("new_filepath"), **{c: F.col(f"_new_{c}") for c in names}}
        return update_where(flagged, hit, values, now).drop("_link", "new_filepath", *[f"_new_{c}" for c in names])
    flagged = base.join(moves.select("symlink", "new_filepath"), "symlink", "left")
    hit = F.col("new_filepath").isNotNull() & active()
    path = F.col("new_filepath")
    values = {"filepath": path, "directory": directory(path)}
    if "basename" in base.columns:
        values["basename"] = basename(file_name(path))
    return update_where(flagged, hit, values, now).drop("new_filepath")


def next_versions(current: DataFrame, rollup: DataFrame, key: str) -> DataFrame:
    """New versions of the entities whose content changed, linked to the ones they replace.

    ``current`` is the catalog's active entities, ``rollup`` the entities as they are now. Emits the
    changed and new ones; a rename of nothing but order cannot occur, since fingerprints ignore it.
    """
    old = current.filter(active()).select(key, F.col("fingerprint").alias("_was"))
    joined = rollup.join(old, key, "left")
    changed = F.col("_was").isNull() | (F.col("_was") != F.col("fingerprint"))
    return joined.filter(changed).withColumns({
        "previous_version": F.coalesce("_was", F.lit("")), "status": F.lit("indexed"),
    }).drop("_was")


def version_rows(current: DataFrame, rollup: DataFrame, key: str, born: Column, now: Column) -> DataFrame:
    """``next_versions`` and the versions they replace, deprecated, in one go: the rows that a pass writes.

    An active entity that the rollup lacks has run empty and is deprecated too. Rows carry ``born``, the pass that made
    the version, and ``row_id``; each side has a key once.
    """
    kinds = {f.name: f.dataType for f in [*rollup.schema, *current.schema]}
    names = list(kinds)

    def entry(side, frame, **own):
        return F.struct(*[own.get(n, F.col(f"{side}.{n}") if n in frame.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names])

    both = current.filter(active()).select(key, F.struct(*current.columns).alias("_c")).join(
        rollup.select(key, F.struct(*rollup.columns).alias("_r")), key, "full_outer")
    differs = ~F.col("_c.fingerprint").eqNullSafe(F.col("_r.fingerprint"))
    new = entry("_r", rollup, row_id=F.concat_ws("@", key, born), born=born, status=F.lit("indexed"), updated_at_DB=now,
                previous_version=F.coalesce("_c.fingerprint", F.lit("")))
    old = entry("_c", current, status=F.lit("deprecated"), next_version=F.col("_r.fingerprint"), updated_at_DB=now)
    return both.filter(differs).select(F.inline(F.array_compact(F.array(
        F.when(F.col("_r").isNotNull(), new), F.when(F.col("_c").isNotNull(), old)))))


def vanished(current: DataFrame, rollup: DataFrame, key: str) -> DataFrame:
    """Active entities that have no files any more."""
    return current.filter(active()).join(rollup.select(key), key, "left_anti")
