"""Near-duplicate vectors: p-stable hashing for Euclidean distance, then exact cosines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, roots, stored

COSINE = 0.98
#: A table's bucket is named by so many projections, each cut into cells of ``WIDTH``.
PROJECTIONS, WIDTH = 10, 1.2
#: At cosine 0.98 (distance 0.2) one projection agrees with probability 0.867, a table with 0.24: all miss with 1e-4.
TABLES = 34
#: Vectors of one bucket that are compared in one task at once; more are dealt to pairs of groups.
CELL = 1024
#: Hot buckets up to this number are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def _units(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Which of the vectors can be compared, and those at length one, in double precision."""
    good, units = np.zeros(len(vectors), bool), []
    for k, v in enumerate(vectors):
        if v is None or not len(v) or any(x is None for x in v):
            continue
        v = np.asarray(v, float)
        if np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            units.append(v / np.sqrt(v @ v))
            good[k] = True
    return good, units


def _hashes(units: np.ndarray, seed: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    draw = np.random.RandomState([seed, units.shape[1]])
    lines = draw.normal(size=(units.shape[1], TABLES * PROJECTIONS))
    shift = draw.uniform(0, WIDTH, TABLES * PROJECTIONS)
    cells = np.floor((units @ lines + shift) / WIDTH).astype(np.int64).reshape(len(units), TABLES, PROJECTIONS)
    odd = draw.randint(1, 2**62, PROJECTIONS).astype(np.int64) * 2 + 1
    mixed = (cells * odd).sum(2)
    return (mixed ^ (mixed >> 29)) * np.int64(odd[0])


def _signed(seed):
    def step(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                good, units = _units(part.column(1).to_pylist())
                rows = np.nonzero(good)[0]
                widths = np.array([len(u) for u in units])
                for width in sorted(set(widths.tolist())):  # vectors of different lengths never link
                    mine = np.nonzero(widths == width)[0]
                    block = np.array([units[i] for i in mine])
                    names = _hashes(block, seed)
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(rows[mine])), pa.array([width] * len(mine), pa.int32()),
                        pa.array([u.tobytes() for u in block], pa.binary()),
                        pa.array([n.tobytes() for n in names], pa.binary()),
                        pa.array(list(names), pa.list_(pa.int64())),
                    ], names=["node", "width", "unit", "names", "buckets"])

    return step


def _linked(cosine):
    """For rows sorted by cell: links that no earlier table has, as a count for every vector and as stars."""

    def cells(rows, run):
        table, node, copies, own, other = (rows.column(c).to_numpy() for c in ("table", "node", "copies", "own", "other"))
        units = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.uint8).reshape(len(node), -1)
        names = np.frombuffer(b"".join(rows.column("names").to_pylist()), np.int64).reshape(len(node), -1)
        ends = np.append(np.nonzero(run[1:] != run[:-1])[0] + 1, len(run))
        many = ends[np.searchsorted(ends, np.arange(len(run)), side="right")] - np.arange(len(run)) - 1
        total, start = np.cumsum(many), 0
        links, a, b = np.zeros(len(node), np.int64), [], []
        while start < len(run):
            done = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + (1 << 15), side="right")))
            x = np.repeat(np.arange(start, stop), many[start:stop])
            y = x + 1 + np.arange(len(x)) + done - np.repeat(total[start:stop] - many[start:stop], many[start:stop])
            # In a cell of two groups only vectors of different groups are compared.
            x, y = (z[(own[x] == other[x]) | (own[x] != own[y])] for z in (x, y))
            if len(x):
                near = np.einsum("ij,ij->i", units[x].view(float), units[y].view(float)) >= cosine
                x, y = x[near], y[near]
                earlier = np.arange(names.shape[1])[None, :] < table[x][:, None]
                new = ~((names[x] == names[y]) & earlier).any(1)
                x, y = x[new], y[new]
            if len(x):
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                x, y = roots(x, y)
                a.append(x)
                b.append(y)
            start = stop
        if a:
            x, y = roots(np.concatenate(a), np.concatenate(b))
            root = node.copy()
            root[x] = node[y]
            keep = links > 0
            yield pa.RecordBatch.from_pydict({"node": node[keep], "links": links[keep], "root": root[keep]})

    def step(batches):
        tail = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if tail is not None:
                rows = pa.concat_tables([tail, rows])
            key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("_of", "table", "bucket", "low", "high")])
            new = np.append(0, (key[:, 1:] != key[:, :-1]).any(0).astype(np.int64))
            run = np.cumsum(new)
            whole = int(np.nonzero(new)[0][-1]) if new.any() else 0
            if whole:
                yield from cells(rows.slice(0, whole).combine_chunks(), run[:whole])
            tail = rows.slice(whole).combine_chunks()
        if tail is not None and len(tail):
            yield from cells(tail, np.zeros(len(tail), np.int64))

    return step


def embedding_groups(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
                     cosine: float = COSINE, seed: int = 5) -> DataFrame:
    """``key``, ``n_links`` (other vectors linked directly), ``component_id`` (least key reachable), ``kept`` for every vector.

    Vectors link when their cosine in double precision is ``cosine`` or more and, with ``label``, their labels are
    equal and not null. Null, empty and zero vectors, and those with a null or non-finite component, link with nothing, nor do
    vectors of different lengths. Links found are exact; a pair at the threshold is found with probability 0.9999.
    Keys are integers. Rows that agree in key, label and vector are one vector and give one row; rows with a null
    key link with nothing. Other columns are ignored; an empty table gives an empty result.

    Equal vectors are compared once, with their number. A bucket with more than ``CELL`` vectors is dealt to groups, and
    each pair of groups is a cell of its own; cells give counts and stars, never all pairs.
    """
    rows = vectors.select(F.col(key).alias("_key"), (F.col(label) if label else F.lit(0)).alias("_label"),
                          F.col(vector).alias("_vector")).distinct()
    rows = stored(rows, "vectors")
    usable = F.col("_key").isNotNull() & F.col("_label").isNotNull() & F.col("_vector").isNotNull() & ~F.exists(
        "_vector", lambda x: x.isNull())
    same = stored(rows.filter(usable).groupBy("_label", "_vector").agg(
        F.min("_key").alias("node"), F.count_distinct("_key").alias("copies")), "distinct-vectors")
    # A key may have several vectors, so nodes are named by both.
    named = same.withColumn("node", F.xxhash64("_label", "_vector"))
    signed = stored(named.select("node", "_vector").mapInArrow(
        _signed(seed), "node long, width int, unit binary, names binary, buckets array<long>"), "signed-vectors")
    body = signed.join(named.select("node", "copies", "_label"), "node").select(
        "node", "copies", "unit", "names", "buckets", F.xxhash64("_label", "width").alias("_of"))
    body = stored(body, "bodies")
    places = body.select("node", "_of", F.posexplode("buckets").alias("table", "bucket"))
    busy = places.groupBy("_of", "table", "bucket").count().filter("count > 1").select(
        "_of", "table", "bucket", F.ceil(F.col("count") / CELL).cast("int").alias("groups"))
    busy = stored(busy, "buckets")
    if busy.count() <= BROADCAST_ROWS:
        busy = F.broadcast(busy)
    dealt = body.select("node", "copies", "unit", "names", "_of", F.posexplode("buckets").alias("table", "bucket")).join(
        busy, ["_of", "table", "bucket"]).withColumn("own", F.pmod(F.xxhash64("node"), "groups").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    cell = ["_of", "table", "bucket", "low", "high"]
    # Most cells hold two or three vectors, so a task takes many at once.
    found = stored(dealt.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(
        _linked(cosine), "node long, links long, root long"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "embedding")
    every = named.join(counts, "node", "left").join(joined, "node", "left").select(
        F.col("_label").alias("l"), F.col("_vector").alias("v"), F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    # A vector that cannot be compared does not link with its own copies either.
    good = signed.select("node").withColumn("good", F.lit(True))
    every = every.withColumn("node", F.xxhash64("l", "v")).join(good, "node", "left").drop("node")
    wide = rows.join(every, (F.col("_label") == F.col("l")) & (F.col("_vector") == F.col("v")) & F.col("_key").isNotNull(), "left")
    wide = stored(wide.select("_key", F.coalesce("good", F.lit(False)).alias("good"), "root", "links"), "linked")
    least = wide.filter("good").groupBy(F.col("root").alias("r")).agg(F.min("_key").alias("least"))
    return wide.join(least, F.col("good") & (F.col("root") == F.col("r")), "left").select(
        F.col("_key").alias(key), F.when(F.col("good"), F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "_key").alias("component_id"),
        F.coalesce(F.coalesce("least", "_key") == F.col("_key"), F.lit(True)).alias("kept"))
