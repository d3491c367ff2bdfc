"""Ordered operators over keys of any size.

A plain ``Window.partitionBy(key)`` sorts a whole key in one task. Here a key is first cut into time
buckets: the window runs inside each (key, bucket), and one row per bucket - of which a key has at
most time range / bucket width - carries the value across bucket borders. The result is that of the
plain window.
"""

from pyspark.sql import DataFrame, Window, functions as F

DAY = 86_400
# The bucket of rows without a time: below that of any time.
NO_TIME = -(1 << 62)


def _cells(df, keys, order, seconds):
    """Rows with their (key, bucket), by which windows, edges and the join back are partitioned.

    The key is a struct, so that null keys are keys like any other in joins too. Rows without a time have a bucket
    of their own before all others, as a plain window sorts them.
    """
    micros = F.unix_micros(F.col(order).cast("timestamp"))
    bucket = F.coalesce(F.floor(micros / F.lit(seconds * 1_000_000)), F.lit(NO_TIME))
    return df.withColumns({"_key": F.struct(*keys), "_bucket": bucket})


_CELL, _HELPERS = ["_key", "_bucket"], ["_key", "_bucket", "_edge"]


def with_neighbours(df: DataFrame, keys, order: str, values, before: str | None = None,
                    after: str | None = None, tie=(), bucket_seconds: int = DAY) -> DataFrame:
    """Add structs of the previous (``before``) and following (``after``) row's ``values`` in the key.

    They are null on the key's first and last row. ``tie`` makes equal times deterministic. Values that are names of the
    order or the tie go through the shuffle of the buckets' ends once, as part of the order.
    """
    order_by = [order, *tie]
    payload, at = F.struct(*values), F.struct(*order_by)
    rows = _cells(df, keys, order, bucket_seconds)
    inside = Window.partitionBy(*_CELL).orderBy(*order_by)
    across = Window.partitionBy("_key").orderBy("_bucket")
    # The row next to a bucket's first one is the last of the bucket before, and the other way round.
    sides = [(into, offset, edge_of) for into, offset, edge_of in
             ((before, F.lag, F.max_by), (after, F.lead, F.min_by)) if into]

    if all(isinstance(v, str) and v in order_by for v in values):
        outer = {F.max_by: F.max, F.min_by: F.min}
        ends = rows.groupBy(*_CELL).agg(*[outer[edge_of](at).alias(f"_at_{into}") for into, _, edge_of in sides]).select(
            *_CELL, *[F.struct(*[F.col(f"_at_{into}.{v}") for v in values]).alias(f"_end_{into}") for into, _, _ in sides])
    else:
        ends = rows.groupBy(*_CELL).agg(*[edge_of(payload, at).alias(f"_end_{into}") for into, _, edge_of in sides])
    edges = ends.select(*_CELL, F.struct(*[
        offset(f"_end_{into}").over(across).alias(into) for into, offset, _ in sides]).alias("_edge"))
    near = rows.withColumns({f"_near_{into}": offset(payload).over(inside) for into, offset, _ in sides})
    return (
        near.join(edges, _CELL)
        .withColumns({into: F.coalesce(f"_near_{into}", f"_edge.{into}") for into, _, _ in sides})
        .drop(*[f"_near_{into}" for into, _, _ in sides], *_HELPERS)
    )


def settled(events: DataFrame, keys, ts: str, gap_seconds: float, tie=(),
            bucket_seconds: int = DAY) -> DataFrame:
    """Debounce: keep an event only if none follows on its key within the gap.

    An event without a time is followed by none.
    """
    near = with_neighbours(events, keys, ts, [F.col(ts).alias("at")], after="_next",
                           tie=tie, bucket_seconds=bucket_seconds)
    micros = _micros("_next.at") - _micros(ts)
    quiet = F.col("_next").isNull() | F.col(ts).isNull() | (micros > int(gap_seconds * 1_000_000))
    return near.filter(quiet).drop("_next")


def sessions(events: DataFrame, keys, ts: str, gap_seconds: float, aggregates, tie=(),
             bucket_seconds: int = DAY) -> DataFrame:
    """Bursts of events per key, separated by more than the gap, with aggregates over each.

    Bursts are found inside each (key, bucket); only a bucket's first burst can go on from the
    bucket before, so what crosses the borders is decided on one row per bucket. Events without a time
    are one burst of their key, with neither start nor end.
    """
    keys, gap = list(keys), int(gap_seconds * 1_000_000)
    rows = _cells(events, keys, ts, bucket_seconds)
    inside = Window.partitionBy(*_CELL).orderBy(ts, *tie)
    opens = F.col("_at").isNull() | (_micros(ts) - _micros("_at") > gap)
    local = (
        rows.withColumn("_at", F.lag(ts).over(inside))
        .withColumn("_opened", F.last(F.when(opens, F.col(ts)), ignorenulls=True).over(
            inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    across = Window.partitionBy("_key").orderBy("_bucket")
    ends = local.groupBy(*_CELL).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.max("_opened").alias("_newest"))
    goes_on = F.coalesce(_micros("_first") - _micros("_before") <= gap, F.lit(False))
    # Where the burst that is open at the end of a bucket began, if it began in this bucket.
    began = F.when(~F.col("_goes_on") | (F.col("_newest") != F.col("_first")), F.col("_newest"))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        ends.withColumn("_before", F.lag("_last").over(across)).withColumn("_goes_on", goes_on)
        .withColumn("_carried", F.last(began, ignorenulls=True).over(earlier))
        .select(*_CELL, F.struct("_first", F.when(F.col("_goes_on"), F.col("_carried")).alias("start")).alias("_edge"))
    )
    start = F.when(F.col("_opened") == F.col("_edge._first"), F.coalesce("_edge.start", "_opened")).otherwise(F.col("_opened"))
    return local.join(edges, _CELL).withColumn("session_start", start).groupBy(*keys, "session_start").agg(
        F.max(ts).alias("session_end"), *aggregates)


def _micros(column):
    return F.unix_micros(F.col(column).cast("timestamp"))
