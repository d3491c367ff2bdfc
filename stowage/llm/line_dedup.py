"""Repeated passages removed from documents by overlapping windows of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import others

WINDOW = 3


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The document's row in ``_row``, its text's lines, and what identifies it."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row"),
        F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text")).alias("_doc"),
        F.split(text, "\n").alias("_lines"))


def _windows(lines: DataFrame, window: int) -> DataFrame:
    """``_doc``, ``at`` (from 0) and two 64-bit hashes of every window that is not all blank."""
    # One element per window; `_all` is an attribute here, so that taking a line does not split the text again.
    places = lines.filter(F.size("_lines") >= window).select("_doc", F.col("_lines").alias("_all")).select(
        "_doc", F.posexplode(F.arrays_zip(*[
            F.slice("_all", k + 1, F.size("_all") - (window - 1)).alias(f"l{k}") for k in range(window)])).alias("at", "w"))
    parts = [F.col("w")[f"l{k}"] for k in range(window)]
    blank = F.concat(*[F.trim(p) for p in parts]) == ""
    return places.filter(~blank).select(
        "_doc", "at", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("h2"))


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``_doc`` and the line numbers (from 0) that later occurrences of windows cover, for documents that have any."""
    windows = _windows(_lines(docs, key, text), window)
    place = F.struct("_doc", "at")
    # Counted map-side: a passage in a third of all documents is one row per task here.
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("final")).filter(
        "first <> final").select("h1", "h2", "first")
    later = windows.join(repeated, ["h1", "h2"]).filter(place != F.col("first"))
    # Places repeat when rows do; one of each is enough.
    return later.groupBy("_doc").agg(F.collect_set("at").alias("_at")).select("_doc", F.array_distinct(F.flatten(
        F.transform("_at", lambda at: F.sequence(at, at + (window - 1))))).alias("_covered"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                count: str | None = "lines_removed") -> DataFrame:
    """All documents with their lines that repeat an earlier passage removed, and in ``count`` how many were.

    A passage is ``window`` consecutive lines, exactly equal and not all blank. Its first occurrence, by key, then
    by a hash of the text, then by line, stays; every line that a later occurrence covers goes, also within one
    document. Texts of fewer lines have no passage. Rows equal in key and text are one document and are treated
    alike; null keys come first; a null text stays null with 0 removed, and a text all of whose lines go becomes
    empty. All columns come back in their order; an input column named as ``count``, in any case, is replaced.

    Documents are joined to what they lose by key and text hash; the number of lines that a row holds is bounded by
    its own document.
    """
    names = others(docs.columns, count or "")
    whole = _lines(docs.select(*[F.col(f"`{c}`") for c in names]), key, text)
    joined = whole.join(removed_lines(docs, key, text, window).withColumnRenamed("_doc", "_of"),
                        F.col("_doc") == F.col("_of"), "left")  # null keys are equal within structs
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_covered"),
                       lambda i: F.col("_lines")[i])
    new = F.when(F.col("_covered").isNull(), F.array_join("_lines", "\n")).otherwise(F.array_join(kept, "\n"))
    columns = [new.alias(text) if c == text else F.col("_row")[c].alias(c) for c in names]
    if count:
        columns.append(F.when(F.col("_covered").isNull(), 0).otherwise(F.size("_covered")).alias(count))
    return joined.select(*columns)
