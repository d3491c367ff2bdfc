"""Documents packed into sequences of a fixed length: first-fit decreasing in randomised groups."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tokens import WordEncoder, default_tokenizer

LENGTH = 2048
END = 1
#: Bytes of text for each group, on average. A group is packed by one task, which holds its token ids.
GROUP_BYTES = 8 << 20


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin and the offset of each size; sizes must be given in descending order and fit a bin.

    The bins' free space is a tournament tree: each inner node has the greater of its two, so the first bin with
    room is found, and the path above it renewed, in as many steps as the tree is deep.
    """
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - tree[node])
        tree[node] -= size
        node //= 2
        while node:
            most = tree[2 * node] if tree[2 * node] >= tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == most:
                break
            tree[node] = most
            node //= 2
    return bins, offsets


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END,
           tokenizer: str | None = None) -> DataFrame:
    """``key``, ``start``, ``length``, ``doc_tokens``, ``ids`` of every piece of at most ``length`` tokens.

    ``ids`` are little-endian unsigned 32-bit integers. A document is its text's ids, then ``end``; a null or empty
    text is ``end`` alone. Only a document's last piece is shorter than ``length``.
    """
    path = tokenizer or default_tokenizer()
    if key.lower() in ("start", "length", "doc_tokens", "ids", "sequence_id", "offset"):
        raise ValueError("the key needs a name that no column of pieces has")

    def step(batches):
        encoder = WordEncoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = encoder.encode(part.column(1).to_pylist(), end)
                total = np.array([len(ids) for ids in found], np.int64)
                number = -(-total // length)
                row = np.repeat(np.arange(len(found)), number)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * length
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(row)), pa.array(start),
                    pa.array(np.minimum(total[row] - start, length)), pa.array(total[row]),
                    pa.array([found[r][s:s + length].tobytes() for r, s in zip(row.tolist(), start.tolist())], pa.binary()),
                ], names=[key, "start", "length", "doc_tokens", "ids"])

    kept = docs.select(key, text)
    empty = F.lit(0).cast("long")
    return kept.mapInArrow(step, kept.select(
        key, empty.alias("start"), empty.alias("length"), empty.alias("doc_tokens"), F.lit(b"").alias("ids")).schema)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END,
         tokenizer: str | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The pieces of all documents with the ``sequence_id`` (long) and ``offset`` (long) at which each lies.

    Pieces go to groups at random, in number proportional to the text, and each group is packed by itself,
    longest first, ties by key, start and ids. Repeated rows are packed each for itself; they are spread over
    groups like others. The draw goes by where a row stands in its task, so ``docs`` should come from a scan, or be stored first. Null keys are kept. Other columns are ignored; an empty table gives an empty result.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))
    cut = pieces(docs, key, text, length, end, tokenizer)
    # A row's place in its task is part of the draw, for else copies of one row would share a group.
    cut = cut.withColumn("_group", F.pmod(F.xxhash64("ids", "start", F.monotonically_increasing_id()), F.lit(groups)))

    def step(table):
        keys = table.column(key)
        order = [(key, "ascending"), ("start", "ascending"), ("ids", "ascending")]
        table = table.take(pa.compute.sort_indices(table, [("length", "descending"), *order]))
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), length)
        group = table.column("_group")[0].as_py() if len(keys) else 0
        return table.drop_columns(["_group"]).append_column(
            "sequence_id", pa.array(np.array(bins, np.int64) + (group << 32))).append_column("offset", pa.array(offsets, pa.int64()))

    schema = cut.drop("_group").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return cut.groupBy("_group").applyInArrow(step, schema)
