"""Placement of rows on shards by a permutation-filled lookup table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import others

#: Slots of the table, a prime well above a hundred times the shards; it bounds what is broadcast (12 bytes a slot).
SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """For each slot the number of its shard in ``shards``.

    Every shard prefers the slots in an order of its own, ``(offset + k * skip) mod slots``, which a prime number of slots
    makes a permutation. The shards take turns, in order of name, and each claims the first slot of its order that is
    free, until none is. So shares differ by one slot at most, and a shard that comes or goes moves few others' slots.
    """
    if not _is_prime(slots) or not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("a prime number of slots, and at least one and at most as many different shards")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    at = [xxhash.xxh64_intdigest(s, 1) % slots for s in shards]
    skip = [xxhash.xxh64_intdigest(s, 2) % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for shard in turns:
            place = at[shard]
            while table[place] >= 0:
                place = (place + skip[shard]) % slots
            table[place] = shard
            at[shard] = (place + skip[shard]) % slots
            left -= 1
            if not left:
                break
    return np.array(table, np.int32)


def slot_of(key: str | Column, slots: int = SLOTS) -> Column:
    """A key's slot; null keys share one."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(F.lit("slot"), key.cast("string")), F.lit(slots)).cast("int")


def placed(rows: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """All rows with ``slot`` (int) and ``shard`` (string), a function of the key alone.

    Equal keys, null among them, share a shard. Nothing is shuffled: the table of ``slots`` rows is broadcast, so rows
    may share keys in any proportion. Input columns named ``slot`` or ``shard``, in any case, are replaced.
    """
    spark: SparkSession = rows.sparkSession
    table = lookup_table(shards, slots)
    found = spark.createDataFrame(pa.table({
        "slot": pa.array(np.arange(slots, dtype=np.int32)), "shard": pa.array(shards, pa.string()).take(pa.array(table))}))
    kept = rows.select(*[F.col(f"`{c}`") for c in others(rows.columns, "slot", "shard")])
    return kept.withColumn("slot", slot_of(key, slots)).join(F.broadcast(found), "slot").select(*kept.columns, "slot", "shard")


def write_shards(rows: DataFrame, path: str, files: int = 1) -> None:
    """Write placed rows under ``path``, a folder for each shard with about ``files`` files in it.

    Rows are dealt to files by where they stand in their task, so ``rows`` should come from a scan, as ``placed`` gives them, or
    be stored first: a lost task that reads a shuffle again could deal them anew.
    """
    spread = F.pmod(F.xxhash64(F.struct(*rows.columns), F.monotonically_increasing_id()), F.lit(files))
    rows.withColumn("_file", spread).repartition("shard", "_file").drop("_file").write.partitionBy("shard").mode(
        "overwrite").parquet(path)
