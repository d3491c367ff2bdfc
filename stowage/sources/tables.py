"""Catalog tables as Parquet in buckets.

A table is a folder that Spark's writer partitions: by a bucket of what the table is looked up by (``in_bucket``), and
within it by the pass that wrote (``as_of``). A pass replaces the partitions of its own number in the buckets it touches
and leaves all others alone, so that repeating it is harmless; a read that knows its buckets lists and opens no others.
``live`` rows are the newest of each key. ``compact`` folds the buckets that have gathered many passes.

What counts is told by a table of finished passes: readers take rows up to the pass they ask for.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.predicates import compile_conditions
from ..operators.versions import live
from ..session import COMPRESSION

#: Buckets of a table, 64 at most; a fixed number for the life of a catalog. A pass reads and writes those its keys fall in.
BUCKETS = 32
#: A bucket is folded in so many parts, each a file at most.
FOLD_PARTS = 8
_PLACE = T.StructType([T.StructField("in_bucket", T.IntegerType()), T.StructField("as_of", T.LongType())])


def bucket(*columns) -> Column:
    """The bucket of the rows with these values."""
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def buckets_of(rows: DataFrame, **places: Column) -> dict[str, list[int]]:
    """The buckets that rows fall in, for each of several ways to place them; one small aggregate of a bit for each bucket."""
    one = F.lit(1).cast("bigint")
    found = rows.agg(*[F.bit_or(F.call_function("shiftleft", one, place)).alias(name) for name, place in places.items()]).first()
    return {name: [b for b in range(BUCKETS) if (found[name] or 0) >> b & 1] for name in places}


def _children(spark, folder, prefix):
    """Paths of the partitions of a folder by the number in their name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    return fs, {int(p.getName()[len(prefix):]): p for p in found if p.getName().startswith(prefix)}


def dealt(df: DataFrame, place: Column) -> DataFrame:
    """Rows with their bucket, dealt by it; adaptive execution splits a bucket that has very many."""
    return df.withColumn("in_bucket", place).hint("rebalance", "in_bucket")


def append_rows(df: DataFrame, root: str, table: str, version: int, place: Column | None = None) -> None:
    """Write a pass's rows, to the buckets that ``place`` says; without one, to a single bucket.

    Rows are dealt by bucket before they are written, unless they have been (``dealt``) and have ``in_bucket``.
    """
    if "in_bucket" not in df.columns:
        df = df.withColumn("in_bucket", F.lit(0)) if place is None else dealt(df, place)
    rows = df.withColumn("as_of", F.lit(version).cast("bigint"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("in_bucket", "as_of").parquet(
        f"{root.rstrip('/')}/{table}", compression=COMPRESSION)


def finish(df: DataFrame, root: str, table: str, version: int) -> None:
    """Write the rows that tell that a pass is finished; also none do."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{table}/as_of={version}")


def read_finished(spark: SparkSession, root: str, table: str, schema: T.StructType, version: int) -> DataFrame:
    """The rows that ``finish`` wrote for a pass."""
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{table}/as_of={version}")


def latest_version(spark: SparkSession, root: str, table: str) -> int:
    """The newest finished pass, or -1."""
    fs, passes = _children(spark, f"{root.rstrip('/')}/{table}", "as_of=")
    done = (v for v in sorted(passes, reverse=True) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(passes[v], "_SUCCESS")))
    return next(done, -1)


def read_rows(spark: SparkSession, root: str, table: str, schema: T.StructType, upto: int | None = None,
              buckets: list[int] | None = None) -> DataFrame:
    """Every row that may still count, with its ``as_of``: of some buckets, up to a pass."""
    folder = f"{root.rstrip('/')}/{table}"
    _, there = _children(spark, folder, "in_bucket=")
    wanted = sorted(there) if buckets is None else [b for b in buckets if b in there]
    if not wanted:  # a local relation, which the planner knows to have no rows, so that it leaves out what is joined to them
        return spark.sql("SELECT * FROM VALUES (0) AS none(n)").filter("n > 0").select(*[
            F.lit(None).cast(f.dataType).alias(f.name) for f in [*schema.fields, _PLACE["as_of"]]])
    # Only the folders asked for are listed; the filter says the same to the plan.
    rows = spark.read.schema(T.StructType([*schema.fields, *_PLACE.fields])).option("basePath", folder).parquet(
        *([folder] if buckets is None else [f"{folder}/in_bucket={b}" for b in wanted]))
    if buckets is not None:
        rows = rows.filter(F.col("in_bucket").isin(wanted))
    return (rows if upto is None else rows.filter(F.col("as_of") <= upto)).drop("in_bucket")


def folded(spark: SparkSession, root: str, table: str, upto: int | None = None, buckets: list[int] | None = None) -> bool:
    """Whether no bucket has rows of two passes, so that none of its rows replaces another."""
    folder = f"{root.rstrip('/')}/{table}"
    _, there = _children(spark, folder, "in_bucket=")
    for b in sorted(there) if buckets is None else [b for b in buckets if b in there]:
        passes = _children(spark, f"{folder}/in_bucket={b}", "as_of=")[1]
        if sum(upto is None or v <= upto for v in passes) > 1:
            return False
    return True


def read_live(spark: SparkSession, root: str, table: str, schema: T.StructType, key, upto: int | None = None,
              only: DataFrame | None = None, columns=None, order=(), buckets: list[int] | None = None,
              standing: Column | None = None) -> DataFrame:
    """The newest row per key (``order`` decides within one pass).

    ``only`` restricts the read to rows whose columns of that name occur in it, before anything is shuffled; it must not
    cut a key in two. ``buckets`` are those that such rows can be in. ``columns`` prunes the scan, since a fold of whole rows
    hides which of them are used. ``standing`` tells which of the newest rows are wanted, of tables that a pass writes no row twice
    to: where buckets hold one pass each, at most one row of a key is so, and there is nothing to fold.
    """
    rows = read_rows(spark, root, table, schema, upto, buckets)
    if columns:
        rows = rows.select(*columns, "as_of")
    if only is not None:
        rows = rows.join(only, only.columns, "left_semi")
    if standing is None or not folded(spark, root, table, upto, buckets):
        rows = live(rows, key, "as_of", *order)
    return (rows if standing is None else rows.filter(standing)).drop("as_of")


def compact(spark: SparkSession, root: str, table: str, schema: T.StructType, key, upto: int, passes: int = 1,
            place: Column | None = None) -> list[int]:
    """Fold the buckets that hold more than so many passes to the newest row per key; which those are.

    The folded rows are written as of ``upto``, which must be finished, and then the older partitions go. Readers as of it or
    later see the same throughout: what is there twice for a while folds to the same rows.
    """
    folder = f"{root.rstrip('/')}/{table}"
    _, there = _children(spark, folder, "in_bucket=")
    held = {b: {v: p for v, p in _children(spark, f"{folder}/in_bucket={b}", "as_of=")[1].items() if v <= upto} for b in there}
    full = sorted(b for b, own in held.items() if len(own) > passes)
    if full:
        keys = [key] if isinstance(key, str) else list(key)
        # Dealt once, by bucket and part of it; a key has one bucket, so that rows are folded where they will be written from.
        cell = {"in_bucket": F.lit(0) if place is None else place, "_part": F.pmod(F.xxhash64(*keys), F.lit(FOLD_PARTS))}
        rows = read_rows(spark, root, table, schema, upto, full).withColumns(cell).repartition(*cell)
        append_rows(live(rows, [*cell, *keys], "as_of").drop("as_of", "_part"), root, table, upto)
        for b in full:
            for v, path in held[b].items():
                if v < upto:
                    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return full


def find(rows: DataFrame, conditions=(), include=None, exclude=(), limit: int = 0) -> DataFrame:
    """Filter by conditions, project, limit; a limit of 0 is none."""
    found = rows.filter(compile_conditions(conditions, rows.schema)) if conditions else rows
    if include:
        found = found.select(*include)
    found = found.drop(*exclude)
    return found.limit(limit) if limit else found


def find_one(rows: DataFrame, field: str, value, order: str) -> DataFrame:
    """At most one row that equals the value (null matches null), the first in the given order."""
    return rows.filter(F.col(field).eqNullSafe(F.lit(value))).orderBy(order).limit(1)


def newest_first(rows: DataFrame, column: str, *tie: str) -> DataFrame:
    return rows.orderBy(F.col(column).desc(), *tie)
