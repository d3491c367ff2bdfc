"""Phrases that occur more often than their parts would have it, mined after Toivonen from a sample and its negative border."""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import forget, stored

LONGEST = 5
LEAST = 100
TOP = 2000
#: One in so many documents is in the sample, where a phrase counts as frequent from this share of what it should have there.
SAMPLE = 8
LOWERED = 0.8
#: Words that a task counts at once; some 150 bytes of memory each.
CHUNK = 1_000_000
#: Bits of the filter that tells tasks which phrases are frequent: 8 MB, whatever their number. Beyond some five million
#: phrases it lets ever more others through, which are then counted too; no result changes.
FILTER_BITS = 26
#: What parts pieces becomes a line feed, a tab a space, A-Z lower case.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
#: Stands between pieces; no text in UTF-8 has this byte.
_GAP = b"\xff"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_and_gaps(text: str | None) -> list[bytes]:
    """The words of a text, with a gap after each piece."""
    return [*text.encode().translate(_BYTES).replace(b"\n", b" \xff ").split(), _GAP] if text else []


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * _ODD
    return values ^ (values >> np.uint64(29))


def _first(word: np.ndarray, lang: str) -> np.ndarray:
    return _mixed(word ^ np.uint64(xxhash.xxh64_intdigest(lang, 1)))


def _longer(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word."""
    return _mixed(phrase + (word ^ (word >> np.uint64(31))))


def phrase_hash(lang: str, phrase: str) -> np.ndarray:
    words = np.array([xxhash.xxh64_intdigest(w) for w in phrase.encode().split(b" ")], np.uint64)
    found = _first(words[:1], lang)
    for k in range(1, len(words)):
        found = _longer(found, words[k:k + 1])
    return found


class Filter:
    """A set of phrases, by two bits each: it has all of them, and may seem to have others."""

    def __init__(self, places: np.ndarray, bits: np.ndarray, size: int = FILTER_BITS):
        self.places, self.bits, self.size, self.table = places, bits, size, None

    @staticmethod
    def bits_of(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For each hash twice the 64-bit word it is in, and its bit there."""
        both = np.concatenate([hashes >> np.uint64(64 - size), (hashes * _ODD) >> np.uint64(64 - size)])
        return (both >> np.uint64(6)).astype(np.int64), np.uint64(1) << (both & np.uint64(63))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.table is None:
            self.table = np.zeros(1 << (self.size - 6), np.uint64)
            self.table[self.places] = self.bits
        places, bits = self.bits_of(hashes, self.size)
        return ((self.table[places] & bits) != 0).reshape(2, -1).all(0)

    def __getstate__(self):
        return self.__dict__ | {"table": None}


def filter_of(phrases: DataFrame, size: int = FILTER_BITS) -> Filter:
    """The filter of (lang, phrase, hash) rows, by the hash where there is no phrase; made by aggregation, so that the driver
    gets it once, whatever the number of rows."""
    def step(batches):
        for batch in batches:
            langs, names, hashes = (batch.column(k).to_pylist() for k in range(3))
            found = np.array([phrase_hash(x, name)[0] if name else np.int64(h).view(np.uint64) for x, name, h in zip(langs, names, hashes)], np.uint64)
            places, bits = Filter.bits_of(found, size)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(bits.view(np.int64))], names=["place", "bits"])

    table = phrases.select("lang", "phrase", "hash").mapInArrow(step, "place long, bits long").groupBy("place").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    return Filter(table.column("place").to_numpy(), table.column("bits").to_numpy().view(np.uint64), size)


# --- what a pass counts ---------------------------------------------------------------------------------
# A rule is asked for the different phrases of each length: their hashes, and what it noted of their first and last parts.
# It tells which are counted, which of these by name, which can be part of longer ones, and what it notes of them. Phrases that
# are not counted by name are counted by their 64-bit hash, whose count is never less than the phrase's.

class Pairs:
    """All words and pairs: the first look at the sample."""

    longest = 2

    def __call__(self, k, hashes, first, last):
        every = np.ones(len(hashes), bool)
        return every, ~every, every, None


class BeyondPairs:
    """Longer phrases, of frequent pairs only: the second look at the sample."""

    def __init__(self, frequent: Filter, longest: int):
        self.frequent, self.longest = frequent, longest

    def __call__(self, k, hashes, first, last):
        every = np.ones(len(hashes), bool)
        return (~every, ~every, self.frequent.has(hashes), None) if k < 3 else (every, ~every, every, None)


class SampleAndBorder:
    """What is frequent in the sample, by name, and its negative border: what is not, though all its parts are."""

    def __init__(self, sampled: Filter, longest: int):
        self.sampled, self.longest = sampled, longest

    def __call__(self, k, hashes, first, last):
        expected = self.sampled.has(hashes)
        return np.ones(len(hashes), bool), expected, expected, None


class Expansion:
    """By name: what of the border may be frequent, and what has not been counted yet and has no part known to be rare."""

    def __init__(self, sampled: Filter, suspected: Filter, frequent: Filter, longest: int):
        self.sampled, self.suspected, self.frequent, self.longest = sampled, suspected, frequent, longest

    def __call__(self, k, hashes, first, last):
        expected, suspected = self.sampled.has(hashes), self.suspected.has(hashes)
        fresh = np.zeros(len(hashes), bool) if k == 1 else ~(first & last)
        take = fresh | (suspected & ~expected)
        return take, take, fresh | suspected | self.frequent.has(hashes), expected


def _counted(ids: np.ndarray, words: pa.Array, hashes: np.ndarray, lang: str, rule):
    """(length, phrases or None, hashes, counts) of a run of word ids in which 0 is a gap."""
    size = np.int64(len(words))

    def shown(k, take, named, start, phrase, counts):
        by_name, by_hash = np.flatnonzero(take & named), np.flatnonzero(take & ~named)
        if len(by_name):
            parts = [words.take(pa.array(ids[start[by_name] + j])) for j in range(k)]
            yield k, parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " "), None, counts[by_name]
        if len(by_hash):
            yield k, None, phrase[by_hash].view(np.int64), counts[by_hash]

    single, start, counts = np.unique(ids, return_index=True, return_counts=True)
    phrase = _first(hashes, lang)
    take, named, alive, notes = rule(1, phrase[single], None, None)
    yield from shown(1, take & (single > 0), named, start, phrase[single], counts)
    # The place of each position's phrase among the different ones; -1 where it is no part of longer ones.
    place = np.full(size, -1, np.int32)
    place[single] = np.where(alive & (single > 0), np.arange(len(single)), -1)
    number, phrase = place[ids], phrase[single]
    for k in range(2, rule.longest + 1):
        at = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0))
        if not len(at):
            return
        codes, place, own, counts = np.unique(
            number[at].astype(np.int64) * size + ids[at + (k - 1)], return_index=True, return_inverse=True, return_counts=True)
        start, before = at[place], codes // size
        phrase = _longer(phrase[before], hashes[codes % size])
        noted = (None, None) if notes is None else (notes[before], notes[number[start + 1]])
        take, named, alive, notes = rule(k, phrase, *noted)
        yield from shown(k, take, named, start, phrase, counts)
        number = np.full(len(ids), -1, np.int32)
        number[at] = np.where(alive[own], own, -1)


def phrase_counts(docs: DataFrame, rule, lang: str = "lang", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``lang``, ``words`` (the length), ``phrase``, ``hash``, ``n``: counts of the phrases that the rule takes.

    Those it names are counted exactly, with hash 0; the others by their hash, which tells languages apart, with an empty phrase and
    language. Length 0 counts all words.
    """
    def flush(texts, ids):
        words = list(ids)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        words = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string())
        for name, arrays in texts.items():
            run = np.concatenate(arrays)
            total = np.array([np.count_nonzero(run)])
            for length, phrases, marks, counts in itertools.chain([(0, pa.array([""]), None, total)], _counted(run, words, hashes, name, rule)):
                for cut in range(0, len(counts), 1 << 16):
                    part = counts[cut:cut + (1 << 16)].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat("" if phrases is None else name, len(part)), pa.array(np.full(len(part), length, np.int32)),
                         pa.repeat("", len(part)) if phrases is None else phrases.slice(cut, 1 << 16),
                         pa.array(np.zeros(len(part), np.int64) if marks is None else marks[cut:cut + (1 << 16)]), pa.array(part)],
                        names=["lang", "words", "phrase", "hash", "n"])

    def fresh():
        ids = defaultdict(itertools.count().__next__)
        ids[_GAP]
        return defaultdict(list), ids

    def step(batches):
        (texts, ids), size = fresh(), 0
        for part in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
            for name, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = words_and_gaps(body)
                if found:
                    texts[name].append(np.fromiter(map(ids.__getitem__, found), np.int32, len(found)))
                    size += len(found)
                if size >= chunk:
                    yield from flush(texts, ids)
                    (texts, ids), size = fresh(), 0
                    pa.default_memory_pool().release_unused()
        yield from flush(texts, ids)

    kept = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    parts = kept.mapInArrow(step, "lang string, words int, phrase string, hash long, n long")
    return parts.groupBy("lang", "words", "phrase", "hash").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, key: str = "doc_id", lang: str = "lang", text: str = "text",
                     sample: int = SAMPLE, lowered: float = LOWERED) -> tuple[DataFrame, int]:
    """All phrases of up to ``longest`` words that occur ``least`` times or more in a language, with their exact counts, stored; and the passes over all texts.

    A phrase is frequent in the sample if it has ``lowered`` of the share of ``least`` that falls to it. The full pass counts these by
    name and their negative border by hash. If something of the border may be frequent, longer ones were not counted that could be
    too: a further pass counts both, and whatever else has no part known to be rare. That leaves nothing open that could be
    frequent, so the search is closed. Length 0 has the number of all words of a language.
    """
    wanted = max(1, int(lowered * least / sample))
    drawn = docs.filter(F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(sample)) == 0)
    short = stored(phrase_counts(drawn, Pairs(), lang, text).filter((F.col("words") > 0) & (F.col("n") >= wanted)), "sample-pairs")
    long = stored(phrase_counts(drawn, BeyondPairs(filter_of(short), longest), lang, text).filter(
        (F.col("words") > 0) & (F.col("n") >= wanted)), "sample-phrases")
    expected = filter_of(short.unionByName(long))
    found = stored(phrase_counts(docs, SampleAndBorder(expected, longest), lang, text).filter(
        (F.col("words") == 0) | (F.col("n") >= least)), "phrases")
    named, suspects = found.filter("words = 0 or phrase <> ''"), found.filter("words > 0 and phrase = ''")
    passes, counts = 1, [named]
    if not suspects.isEmpty():
        rule = Expansion(expected, filter_of(suspects), filter_of(named.filter("words > 0")), longest)
        counts.append(stored(phrase_counts(docs, rule, lang, text).filter((F.col("words") > 0) & (F.col("n") >= least)), "more-phrases"))
        passes += 1
    whole = stored((counts[0] if len(counts) == 1 else counts[0].unionByName(counts[1])).drop("hash"), "frequent-phrases")
    for part in (short, long, found, *counts[1:]):
        forget(part)
    return whole, passes


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, key: str = "doc_id", lang: str = "lang",
                 text: str = "text", **options) -> DataFrame:
    """The ``top`` phrases of each language by how much more often they occur than their parts: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. A phrase of 2 to ``longest``
    words with ``a`` >= ``least`` occurrences, overlapping ones included, has for each cut in two the score floor(1000 a n / (l r)): ``n``
    words in the language, ``l`` and ``r`` occurrences of the parts. The lowest score counts, the earliest cut among equals.
    Phrases inside a longer one that occurs as often are dropped. Ties go to the greater ``a``, then to the lesser phrase.

    Null texts are empty, a null language is ``und``; repeated rows count each; an empty table gives no rows. Other
    columns are not read, whatever their names.
    """
    counted, _ = frequent_phrases(docs, least, longest, key, lang, text, **options)
    known = counted.filter("words > 0").select("lang", "phrase", "n")
    found = counted.filter("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("own"))

    def joined(start, size):
        return F.array_join(F.slice("own", start, size), " ")

    size = F.size("own")
    shorter = found.filter(size > 2).select("lang", "a", F.explode(F.array(joined(1, size - 1), joined(2, size - 1))).alias("phrase"))
    within = shorter.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    outer = found.join(within, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    cuts = outer.select("lang", "phrase", "a", "own", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("head"), joined(F.col("cut") + 1, size).alias("tail"))
    parted = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"]).join(
        known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    totals = counted.filter("words = 0").select("lang", "n")
    wide = {c: f"CAST({c} AS DECIMAL(38,0))" for c in "anlr"}
    scored = parted.join(totals, "lang").withColumn(
        "score", F.expr(f"(1000BD * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("cut"))
    by = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    result = stored(ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
                                  F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")), "collocations")
    forget(counted)
    return result
