"""What several operators share: tables, stored intermediates, Arrow steps, disjoint sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import run_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """The rows written to the shared folder and read back: they outlive lost executors. ``options`` go to Spark's writer."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.options(**options).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def forget(df: DataFrame) -> None:
    """Delete a stored intermediate that no later result reads."""
    forget_folder(df.sparkSession, df.stored_at)


def forget_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def others(columns: list[str], *names: str) -> list[str]:
    """The columns but those named so, in any case: Spark does not tell names apart by case."""
    lowered = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in lowered]


def unsigned_hex(column: str | Column) -> Column:
    """A 64-bit number as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def by_batch(function: Callable, make: Callable[[], object] | None = None) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``: the function over each batch; with ``make``, also given what that makes once a task."""

    def run(batches):
        state = () if make is None else (make(),)
        for batch in batches:
            if batch.num_rows:
                yield function(batch, *state)

    return run


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as stars: each node but the least of its component, and that least node."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    label, left, right = np.arange(len(nodes)), places[: len(a)], places[len(a):]
    while len(left):
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``root`` (the least node reachable) for every node of an edge list ``a``, ``b`` of longs.

    Alternating large and small stars: each round is two aggregates with a map-side part and two joins that
    adaptive execution may split, since a hub can have any number of neighbours. Nothing is gathered; the
    rounds are logarithmic in the longest path. Each round is stored, the one before deleted.
    """
    now = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        count, total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, total) == before or not count:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = count, total
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = stored(large.distinct(), name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # Every larger neighbour of a node is known to it as a row; its smaller ones move to the least of them.
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        after = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), name)
        forget(now)
        forget(large)
        now = after
