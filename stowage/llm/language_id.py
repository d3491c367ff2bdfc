"""Language of documents by compression with a dictionary for each language."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import by_batch

#: Sampled texts of each language, and bytes of each that its dictionary takes: the bound on what is fitted.
SAMPLES, SAMPLE_BYTES = 256, 256
#: Drawn texts up to this number are broadcast (some 30 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Texts are compressed in parts of this many bytes, so that a long text does not become its own dictionary.
PART = 2048
#: Greedy search with a chain of eight, matches of three bytes and more.
SETTINGS = dict(window_log=18, chain_log=17, hash_log=17, search_log=3, min_match=3, target_length=32,
                strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False)
#: Two languages closer than this share of the better one's bytes are not told apart.
MARGIN = 0.005

_LETTER = regex.compile(r"\p{L}")
_BETWEEN = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The text's letters in lower case, runs of anything else as one space: case and signs tell no language."""
    return _BETWEEN.sub(" ", text).lower().encode()


def dictionaries(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                 samples: int = SAMPLES, sample_bytes: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary for every language, that of most documents first: pieces of at most ``samples`` texts.

    Texts are drawn by their hash. Null texts and languages, and texts without a letter, are not learned from; of
    repeated texts one is enough.
    """
    rows = docs.select(F.col(lang).alias("_lang"), F.col(text).alias("_text")).filter(
        F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}"))
    draw = F.xxhash64(F.lit(21), "_text")
    # One hash for each language and slot; the texts that have it are fetched afterwards.
    drawn = rows.groupBy("_lang", F.pmod(draw, F.lit(samples)).alias("_slot")).agg(
        F.min(draw).alias("_draw"), F.count(F.lit(1)).alias("_many")).select("_lang", "_draw", "_many")
    if drawn.count() <= BROADCAST_ROWS:
        drawn = F.broadcast(drawn)
    # The piece begins at a place that the hash names, anywhere in the whole text.
    found = rows.withColumn("_draw", draw).join(drawn, ["_lang", "_draw"]).groupBy("_lang", "_draw").agg(
        F.min("_text").alias("text"), F.max("_many").alias("many"))

    def step(batch):
        pieces = []
        for at, text in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            whole = letters(text)
            start = at % max(1, len(whole) - sample_bytes + 1)
            pieces.append(whole[start:start + sample_bytes])
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(pieces, pa.binary())],
                                          names=["lang", "draw", "many", "piece"])

    got = found.select("_lang", "_draw", "many", "text").mapInArrow(
        by_batch(step), "lang string, draw long, many long, piece binary").collect()
    pieces: dict[str, list] = {}
    many: dict[str, int] = {}
    for row in sorted(got, key=lambda r: (r["lang"], r["draw"])):
        pieces.setdefault(row["lang"], []).append(bytes(row["piece"]))
        many[row["lang"]] = many.get(row["lang"], 0) + row["many"]
    return {name: b"\n".join(pieces[name]) for name in sorted(pieces, key=lambda n: (-many[n], n))}


class _Compressors:
    def __init__(self, found: dict[str, bytes]):
        self.names, self.all = list(found), []
        settings = zstandard.ZstdCompressionParameters(**SETTINGS)
        for name in self.names:
            content = zstandard.ZstdCompressionDict(found[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            self.all.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=content))

    def sizes(self, text: str) -> list[int]:
        """Bytes that the whole text takes with each dictionary."""
        data = letters(text)
        parts = [data[k:k + PART] for k in range(0, len(data), PART)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.all]


def languages(docs: DataFrame, found: dict[str, bytes], key: str = "doc_id", text: str = "text",
              margin: float = MARGIN) -> DataFrame:
    """``key``, ``lang_best``, ``score``, ``accepted`` for every row of ``docs``, from its whole text alone.

    ``lang_best`` is the language whose dictionary makes the text smallest (ties: the one with more documents learned from, then by name); ``score`` the margin
    to the next, as a share from 0 to 1 of the next one's bytes (1 if there is no other); ``accepted`` whether that is
    ``margin`` or more. A null text, one without a letter, and every text if no language was learned is ``und`` with
    score 0, not accepted. Repeated rows give repeated results; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(found)
    kept = docs.select(key, text)

    def step(batches):
        tools = _Compressors(held.value)
        for batch in batches:
            best, score = [], []
            for t in batch.column(1).to_pylist():
                if t is None or not tools.names or not _LETTER.search(t):
                    best.append("und")
                    score.append(0.0)
                    continue
                sizes = tools.sizes(t)
                order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
                best.append(tools.names[order[0]])
                score.append(1.0 if len(order) == 1 else 1 - sizes[order[0]] / sizes[order[1]])
            ok = np.array([b != "und" and s >= margin for b, s in zip(best, score)], bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best), pa.array(score), pa.array(ok)],
                                             names=[key, "lang_best", "score", "accepted"])

    schema = kept.select(key, F.lit("").alias("lang_best"), F.lit(0.0).alias("score"), F.lit(True).alias("accepted")).schema
    return kept.mapInArrow(step, schema)


def held_out(key: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept for measuring: the checksum of its key as text leaves this remainder."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
