"""Passages of a benchmark in documents, by spaced-seed hashes and substitution-tolerant verification."""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

#: An overlap is this many aligned words of which all but ``SUBSTITUTIONS`` are equal: a similarity of 0.8 or more.
WINDOW = 13
SUBSTITUTIONS = 2
#: Word positions that a seed reads; it ignores the others. Whichever two words of thirteen differ, one of the seeds
#: has a place that reads neither (tests/llm/test_decontamination.py tries all), so no overlap is missed.
SEEDS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: Items shorter than ``WINDOW`` are searched whole; from this length on one of their words may differ.
TOLERANT = 8
#: Characters of benchmark text that are held by a task at once (about 30 bytes of memory each). A larger benchmark
#: is searched in blocks of this size, each against all documents.
BLOCK_CHARS = 4 << 20



def allowed(words: int) -> int:
    """How many words of a window, or of a whole item that is shorter, may differ."""
    return SUBSTITUTIONS if words >= WINDOW else 1 if words >= TOLERANT else 0


_WORD = re.compile(r"\w+")
_ODD = np.random.RandomState(7).randint(1, 2**62, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """64-bit hashes of lower-cased words, remembered within bounds."""

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.lower())
        return value


def _words(texts, known):
    """Hashes of the words of all texts in one array, and where each text begins in it."""
    found = [_WORD.findall(t) if t else [] for t in texts]
    ends = np.cumsum([0, *(len(w) for w in found)])
    return np.fromiter((known[w] for words in found for w in words), np.uint64, ends[-1]), ends


def _spaced(words: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """The hash at every position, of the words at these places from it on."""
    n = len(words) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for p in places:
        total += words[p:p + n] * _ODD[p]
    total ^= total >> np.uint64(32)
    return total * _ODD[63]


class _Index:
    """The benchmark's words, and for every seed its hashes in order with the positions that have them."""

    def __init__(self, items, known):
        self.words, self.ends = _words(items, known)
        lengths = np.diff(self.ends)
        self.owner = np.repeat(np.arange(len(lengths)), lengths)
        self.window = np.where(lengths >= WINDOW, WINDOW, lengths)
        self.least = self.window - np.array([allowed(n) for n in range(WINDOW + 1)])[self.window]
        self.seeds = []
        seeds = [(seed, lengths >= WINDOW, False) for seed in SEEDS]
        for n in np.unique(lengths[(lengths > 0) & (lengths < WINDOW)]).tolist():
            # Whichever single word differs, either the even or the odd places are as they were.
            seeds += [(tuple(range(k, n, 1 + allowed(n))), lengths == n, True) for k in range(1 + allowed(n))]
        for places, of, whole in seeds:
            hashes = _spaced(self.words, places)
            at = np.arange(len(hashes))
            at = at[(self.owner[at] == self.owner[at + places[-1]]) & of[self.owner[at]]]
            if whole:
                at = at[at == self.ends[self.owner[at]]]
            if len(at):
                at = at[np.argsort(hashes[at], kind="stable")]
                bits = min(26, max(12, int(len(at)).bit_length() + 5))
                maybe = np.zeros(1 << bits, bool)
                maybe[hashes[at] >> np.uint64(64 - bits)] = True
                self.seeds.append((places, hashes[at], at, maybe, np.uint64(64 - bits)))

    def hits(self, words):
        """Pairs (position in the words, position in the benchmark) whose hashes are equal."""
        for places, hashes, at, maybe, shift in self.seeds:
            own = _spaced(words, places)
            here = np.nonzero(maybe[own >> shift])[0]
            low = np.searchsorted(hashes, own[here], "left")
            many = np.searchsorted(hashes, own[here], "right") - low
            total = np.cumsum(many)
            for start in range(0, int(total[-1]) if len(total) else 0, 1 << 21):
                rank = np.arange(start, min(start + (1 << 21), total[-1]))
                which = np.searchsorted(total, rank, "right")
                yield here[which], at[low[which] + rank - (total[which] - many[which])]


def _overlaps(words, ends, index):
    """For each text and item that overlap: their numbers, which of the text's words are covered, and how many are equal."""
    seen = set()
    text_of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    for p, q in index.hits(words):
        # An alignment is a text, an item, and the distance between their positions.
        pairs = np.unique(np.stack([text_of[p], index.owner[q], p - q]), axis=1)
        seen.update(zip(*pairs.tolist()))
    found = {}
    for text, item, shift in seen:
        first = max(ends[text], index.ends[item] + shift)
        last = min(ends[text + 1], index.ends[item + 1] + shift)
        window = int(index.window[item])
        if last - first < window:
            continue
        equal = words[first:last] == index.words[first - shift:last - shift]
        sums = np.concatenate([[0], np.cumsum(equal)])
        good = np.nonzero(sums[window:] - sums[:-window] >= index.least[item])[0]
        if len(good):
            covered = np.zeros(last - first + 1, np.int64)
            np.add.at(covered, good, 1)
            np.add.at(covered, good + window, -1)
            covered = np.cumsum(covered)[:-1] > 0
            places, same = found.setdefault((text, item), (set(), set()))
            places.update((np.nonzero(covered)[0] + first - ends[text]).tolist())
            same.update((np.nonzero(covered & equal)[0] + first - ends[text]).tolist())
    return found


def _blocks(benchmark, item, item_text, block_chars):
    """The benchmark in blocks of bounded size, each sent to all tasks in its turn."""
    tests = benchmark.select(item, item_text).filter(F.col(item_text).isNotNull()).distinct()
    number = math.ceil((tests.agg(F.sum(F.length(item_text))).first()[0] or 0) / block_chars)
    for block in range(number):
        part = tests.filter(F.pmod(F.xxhash64(F.lit(3), item, item_text), F.lit(number)) == block)
        yield benchmark.sparkSession.sparkContext.broadcast(part.toArrow())


def _searched(batches, place, held):
    """For every part of the batches: the part, its texts, the items, their index, and what overlaps."""
    known, items = _Hashes(), held.value
    index = _Index(items.column(1).to_pylist(), known)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = part.column(place).to_pylist()
            yield part, texts, items, index, _overlaps(*_words(texts, known), index)


def _spans(text, places):
    """Characters from the first to after the last word of each run of covered words."""
    bounds = [m.span() for m in _WORD.finditer(text)]
    spans, before = [], None
    for k in sorted(places):
        if before is not None and k == before + 1:
            spans[-1]["end"] = bounds[k][1]
        else:
            spans.append({"start": bounds[k][0], "end": bounds[k][1]})
        before = k
    return spans


def contaminations(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                   item: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each row of ``docs`` and benchmark item that overlap.

    ``key``, ``item``, ``overlap_words`` (words of the document that an overlap covers), ``equal_words`` (those equal to
    the item's), ``item_words``, ``spans`` (characters from ``start`` to before ``end``, apart and in order).

    Words are runs of letters, digits and underscores, lower-cased. A document overlaps an item where, in some alignment
    without gaps, ``WINDOW`` successive words have ``WINDOW - SUBSTITUTIONS`` or more equal ones; items shorter than the
    window must be there as a whole, with one word differing if they have ``TOLERANT`` or more, else word for word.
    Whole texts are searched. Null and empty texts, and items without a word, match nothing; repeated documents give repeated
    results, equal rows of the benchmark are one; keys may be null; other columns are ignored; if either table is
    empty, so is the result.

    Documents are not shuffled: hashes of a bounded block of the benchmark go to every task, which joins them with the
    hashes of its own documents and verifies the hits in place, so that a passage in very many documents is no hot key.
    """
    kept = docs.select(key, text)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = T.StructType([
        kept.schema[key], benchmark.schema[item], *[T.StructField(n, T.LongType()) for n in ("overlap_words", "equal_words", "item_words")],
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    if key == item:
        raise ValueError("the two keys need different names")

    def searched(held):
        def step(batches):
            for part, texts, items, index, found in _searched(batches, 1, held):
                if found:
                    rows, which = map(list, zip(*found))
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(rows, pa.int64())),
                        items.column(0).combine_chunks().take(pa.array(which, pa.int64())),
                        pa.array([len(p) for p, _ in found.values()], pa.int64()),
                        pa.array([len(s) for _, s in found.values()], pa.int64()),
                        pa.array(np.diff(index.ends)[which].astype(np.int64)),
                        pa.array([_spans(texts[r], p) for r, (p, _) in zip(rows, found.values())], span_type),
                    ], names=[key, item, "overlap_words", "equal_words", "item_words", "spans"])

        return kept.mapInArrow(step, schema)

    found = [searched(held) for held in _blocks(benchmark, item, item_text, block_chars)]
    return functools.reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that overlap no item, as they are; rows without a text stay. Nothing is shuffled."""
    place = docs.columns.index(text)

    def cleared(held):
        def step(batches):
            for part, _, _, _, found in _searched(batches, place, held):
                clean = np.ones(part.num_rows, bool)
                clean[[row for row, _ in found]] = False
                yield part.filter(pa.array(clean))

        return step

    for held in _blocks(benchmark, item, item_text, block_chars):
        docs = docs.mapInArrow(cleared(held), docs.schema)
    return docs
