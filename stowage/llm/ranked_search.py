"""Ranked lexical search: summed accumulators of short posting lists inside document-at-a-time skipping over long ones."""

from __future__ import annotations

import itertools
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.taskcontext import TaskContext

from .common import stored

TOP = 10
#: A shard of the index is closed when it has so many bytes of text or so many documents.
SHARD_BYTES = 16 << 20
SHARD_DOCUMENTS = 1 << 15
#: Documents that share a bound; a block whose bound cannot reach the best is skipped.
BLOCK = 128
#: Lists with at most one in so many of a shard's documents are short.
SHORT = 32
#: Bytes of item text that go to all tasks at once; more items are searched in further blocks.
ITEM_BYTES = 4 << 20
#: Everything but digits, ASCII letters and what is not ASCII parts terms; only A-Z change case.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERMS).split() if text else []


def quotients(counts: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of its weight, from its occurrences and the length norm of the document."""
    return (1_000_000_000 * counts) // (1000 * counts + 8 * norms)


def length_norms(lengths: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    if 90 * int(lengths.max(initial=0)) * documents >= 1 << 63:
        lengths = lengths.astype(object)
    return (10 + (90 * lengths * documents) // tokens).astype(np.int64)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# --- the index ------------------------------------------------------------------------------------------

_ARRAYS = {"lengths": "<i8", "hashes": "<u8", "term_ends": "<i8", "list_ends": "<i8", "places": "<u4", "counts": "<u4"}
_BINARY = [*_ARRAYS, "terms"]
#: How an index is stored: a row group for each shard, since the writer else gathers a hundred rows of megabytes before it looks at
#: their size, and the reader takes a group whole; without statistics, which hold the least and greatest of each group until the file ends.
ROW_GROUPS = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"}


class _Shard:
    """Documents gathered until they make one row of the index."""

    def __init__(self):
        self.ids = defaultdict(itertools.count().__next__)
        self.keys, self.tokens, self.bytes = [], [], 0

    def add(self, keys: pa.Array, texts: pa.Array) -> None:
        found = []
        for text in texts.to_pylist():
            words = terms(text)
            found.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
            self.bytes += len(text or "")
        kept = [k for k, tokens in enumerate(found) if len(tokens)]
        self.keys.append(keys.take(pa.array(kept, pa.int64())))
        self.tokens.extend(found[k] for k in kept)

    def row(self, number: int) -> dict | None:
        if not self.tokens:
            return None
        keys = pa.concat_arrays(self.keys)
        # Documents in the order of their keys, so that a lower place wins a tie.
        order = pc.sort_indices(keys, sort_keys=[("", "ascending")], null_placement="at_start").to_numpy()
        tokens = [self.tokens[k] for k in order]
        lengths = np.array([len(t) for t in tokens], "<i8")
        words = list(self.ids)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        by_hash = np.argsort(hashes, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[by_hash] = np.arange(len(words))
        places = np.repeat(np.arange(len(tokens)), lengths)
        pairs, counts = np.unique(rank[np.concatenate(tokens)] * len(tokens) + places, return_counts=True)
        words = [words[k] for k in by_hash.tolist()]
        made = {
            "lengths": lengths, "hashes": hashes[by_hash], "term_ends": np.cumsum([len(w) for w in words]),
            "list_ends": np.cumsum(np.bincount(pairs // len(tokens), minlength=len(words))),
            "places": pairs % len(tokens), "counts": counts}
        return {"shard": number, "keys": keys.take(pa.array(order)), "documents": len(tokens), "tokens": int(lengths.sum()),
                "terms": b"".join(words), **{k: v.astype(_ARRAYS[k]).tobytes() for k, v in made.items()}}


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES,
          shard_documents: int = SHARD_DOCUMENTS) -> DataFrame:
    """One row for each shard of documents: their keys and lengths, and the posting list of every term in them.

    Documents stay in the task that reads them; nothing is shuffled. A shard's arrays are little-endian binaries.
    Documents without a term, null and empty texts among them, are left out.
    """
    kept = docs.select(key, text)
    kind = kept.schema[0].dataType

    def step(batches):
        shard, number = _Shard(), TaskContext.get().partitionId() << 32

        def row(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([found["shard"]], pa.int64()), pa.ListArray.from_arrays([0, len(found["keys"])], found["keys"]),
                 pa.array([found["documents"]], pa.int64()), pa.array([found["tokens"]], pa.int64()),
                 *[pa.array([found[c]], pa.binary()) for c in _BINARY]],
                names=["shard", "keys", "documents", "tokens", *_BINARY])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                shard.add(part.column(0), part.column(1))
                if shard.bytes >= shard_bytes or len(shard.tokens) >= shard_documents:
                    if found := shard.row(number):
                        yield row(found)
                    shard, number = _Shard(), number + 1
        if found := shard.row(number):
            yield row(found)

    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("keys", T.ArrayType(kind)), T.StructField("documents", T.LongType()),
        T.StructField("tokens", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in _BINARY]])
    return kept.mapInArrow(step, schema)


def _view(batch, row: int, name: str) -> np.ndarray:
    return np.frombuffer(batch.column(batch.schema.get_field_index(name))[row].as_buffer(), _ARRAYS[name])


class _Lookup:
    """Finds given terms in shards."""

    def __init__(self, wanted: list[bytes]):
        self.wanted = wanted
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, wanted), np.uint64, len(wanted))

    def __call__(self, batch, row: int):
        """(number of a wanted term, its slot in the shard) of those that the shard has."""
        hashes, ends = _view(batch, row, "hashes"), _view(batch, row, "term_ends")
        spelled = batch.column(batch.schema.get_field_index("terms"))[row].as_buffer()
        first, last = np.searchsorted(hashes, self.hashes, "left"), np.searchsorted(hashes, self.hashes, "right")
        for number in np.flatnonzero(last > first).tolist():
            for slot in range(first[number], last[number]):  # of terms with one hash, that which is spelled so
                if spelled[ends[slot - 1] if slot else 0:ends[slot]].to_pybytes() == self.wanted[number]:
                    yield number, slot


def _holding(found: DataFrame, wanted: list[bytes]) -> dict[int, int]:
    """The number of documents that hold each of the wanted terms; terms of none are left out."""
    def step(batches):
        look, sums = _Lookup(wanted), np.zeros(len(wanted), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                ends = _view(batch, row, "list_ends")
                for number, slot in look(batch, row):
                    sums[number] += ends[slot] - (ends[slot - 1] if slot else 0)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["number", "holding"])

    counted = found.select("hashes", "terms", "term_ends", "list_ends").mapInArrow(step, "number long, holding long")
    return {r.number: r.holding for r in counted.groupBy("number").agg(F.sum("holding").alias("holding")).collect()}


# --- the search -----------------------------------------------------------------------------------------

def best_places(weighted: list[tuple[int, object]], lists: dict, documents: int, top: int, least: int) -> list[tuple[int, int]]:
    """(score, place) of the best documents of a shard, best first, with at least ``least``; none that could be among the best is missing.

    ``weighted`` has (weight, term) of the item; ``lists`` gives for a term its places, quotients, and, if it is a long
    list, the quotients of all places and the highest in each block. Short lists are summed up first, and these
    sums are one more list, bounded in each block. Blocks are visited in the order of documents; one whose bounds add up
    to less than the best so far is skipped, and within a block the lists are added until none can reach it any more.
    """
    short = [(w, lists[t]) for w, t in weighted if t in lists and lists[t].dense is None]
    long = [(w, lists[t]) for w, t in weighted if t in lists and lists[t].dense is not None]
    blocks = -(-documents // BLOCK)
    sums = np.zeros(blocks * BLOCK, np.int64)
    for w, x in short:
        sums[x.places] += w * x.quotients
    reached = sums[sums > 0]
    least = max(least, 1)
    if len(reached) >= top:  # each of these will have its sum at the least
        least = max(least, int(np.partition(reached, len(reached) - top)[len(reached) - top]))
    bounds = np.array([sums.reshape(blocks, BLOCK).max(1), *[w * x.block_max for w, x in long]])
    bound = bounds.sum(0)
    best: list[tuple[int, int]] = []
    for b in np.flatnonzero(bound >= least).tolist():
        if bound[b] < least:
            continue
        scores, rest = sums[b * BLOCK:(b + 1) * BLOCK].copy(), int(bound[b] - bounds[0, b])
        for k in np.argsort(-bounds[1:, b]).tolist():
            if not rest or int(scores.max()) + rest < least:
                break
            w, x = long[k]
            scores += w * x.dense[b * BLOCK:(b + 1) * BLOCK].astype(np.int64)
            rest -= int(bounds[1 + k, b])
        if rest:
            continue
        for k in np.flatnonzero(scores >= least).tolist():
            best.append((-int(scores[k]), b * BLOCK + k))
        if len(best) > top:
            best.sort()
            del best[top:]
        if len(best) == top:
            least = max(least, -max(best)[0])
    return [(-s, place) for s, place in sorted(best)]


class _List:
    def __init__(self, places, quotients_, documents: int):
        self.places, self.quotients, self.dense = places, quotients_, None
        if len(places) * SHORT > documents:
            self.dense = np.zeros(-(-documents // BLOCK) * BLOCK, np.int32)  # a quotient is a million at most
            self.dense[places] = quotients_
            self.block_max = self.dense.reshape(-1, BLOCK).max(1).astype(np.int64)


def _order(found):
    score, key = found
    return -score, key is not None, key if key is not None else 0


def _searched(found: DataFrame, items: list[tuple[int, list[tuple[int, int]]]], wanted: list[bytes], documents: int, tokens: int,
              top: int) -> DataFrame:
    """The best of each task for each item: ``_item``, ``_key``, ``_score``."""
    kind = found.schema["keys"].dataType.elementType

    def step(batches):
        look, best, key_type = _Lookup(wanted), defaultdict(list), None
        for batch in batches:
            for row in range(batch.num_rows):
                lengths, ends = _view(batch, row, "lengths"), _view(batch, row, "list_ends")
                places, counts = _view(batch, row, "places"), _view(batch, row, "counts")
                norms, lists = length_norms(lengths, documents, tokens), {}
                for number, slot in look(batch, row):
                    own = slice(ends[slot - 1] if slot else 0, ends[slot])
                    lists[number] = _List(places[own], quotients(counts[own].astype(np.int64), norms[places[own]]), len(lengths))
                keys = batch.column(batch.schema.get_field_index("keys"))[row].values
                key_type = keys.type
                for item, weighted in items:
                    so_far = best[item]
                    least = so_far[top - 1][0] if len(so_far) >= top else 1
                    more = best_places(weighted, lists, len(lengths), top, least)
                    if more:
                        so_far.extend((score, keys[place].as_py()) for score, place in more)
                        so_far.sort(key=_order)
                        del so_far[top:]
        rows = [(item, key, score) for item, own in best.items() for score, key in own]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], key_type),
                 pa.array([r[2] for r in rows], pa.int64())], names=["_item", "_key", "_score"])

    from pyspark.sql import types as T

    return found.select("keys", *_BINARY).mapInArrow(step, T.StructType([
        T.StructField("_item", T.LongType()), T.StructField("_key", kind), T.StructField("_score", T.LongType())]))


def search(found: DataFrame, items: DataFrame, item: str = "item_id", item_text: str = "text", key: str = "doc_id", top: int = TOP,
           item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item``, ``rank``, ``key``, ``score`` of the ``top`` highest-scoring documents of an ``index`` for each item, over the whole index.

    Scores are whole numbers: a term that ``df`` of the ``N`` documents with any term hold weighs
    floor(1000 ln((2N + 2) / (2 df + 1))), and adds its weight times a quotient that grows with its occurrences and
    shrinks with the document's length. Ties go to the lower key, null before all. An item's terms count once each. An
    item with a null or empty text, or without a known term, has no rows; rows equal in ``item`` and text are one item;
    rows of one ``item`` with different texts are ranked each for itself. Other columns are ignored.

    Items go to all tasks in blocks of about ``item_bytes`` of text, each a pass over the index; a task keeps the best
    of all its shards, and their threshold goes from shard to shard. What is merged is ``top`` rows for each item and task.
    """
    session = found.sparkSession
    total = found.agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).first()
    asked = items.select(F.col(item).alias("_id"), F.col(item_text).alias("_text")).distinct()
    size = asked.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / item_bytes))
    id_type = asked.schema["_id"].dataType.simpleString()
    parts, number = [], 0
    for block in range(blocks if total.documents else 0):
        rows = asked.filter(F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)) == block).collect()
        own = [(k, r._id, sorted(set(terms(r._text)))) for k, r in enumerate(rows, number)]
        number += len(rows)
        wanted = sorted({t for _, _, ts in own for t in ts})
        at = {t: k for k, t in enumerate(wanted)}
        holding = _holding(found, wanted)
        weights = {k: weight(total.documents, n) for k, n in holding.items()}
        weighted = [(k, [(weights[at[t]], at[t]) for t in ts if weights.get(at[t])]) for k, _, ts in own]
        ids = session.createDataFrame([(k, i) for k, i, _ in own], f"_item long, _id {id_type}")
        best = _searched(found, weighted, wanted, total.documents, total.tokens, top)
        parts.append(best.join(F.broadcast(ids), "_item"))
    if not parts:
        key_type = found.schema["keys"].dataType.elementType.simpleString()
        return session.createDataFrame([], f"`{item}` {id_type}, rank int, `{key}` {key_type}, score long")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    by = Window.partitionBy("_item").orderBy(F.desc("_score"), F.asc_nulls_first("_key"))
    ranked = every.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    return ranked.select(F.col("_id").alias(item), "rank", F.col("_key").alias(key), F.col("_score").alias("score"))


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``search`` over an index of ``docs`` that is written to the shared folder first. The result is stored, the index deleted."""
    from .common import forget

    found = stored(index(docs, key, text), "search-index", **ROW_GROUPS)
    result = stored(search(found, items, key=key, **options), "search-result")
    forget(found)
    return result
