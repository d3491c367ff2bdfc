"""The registered queries of this package: each operator, with production parameters, over its whole table."""

import corpus_pipeline
from pyspark.sql import DataFrame, functions as F

from ..session import run_dir
from . import decontamination, embedding_dedup, exact_dedup, language_id, line_dedup, packing, phrases, quality, ranked_search, sharding, simhash, token_counts, warc
from .common import table, unsigned_hex

QUERIES = {}
#: Shards that documents are placed on.
SHARDS = [f"shard-{k:03d}" for k in range(256)]


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_packing(spark, d) -> DataFrame:
    return packing.pack(table(spark, d, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_decontamination(spark, d) -> DataFrame:
    found = decontamination.contaminations(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id", "item_id", "overlap_words", "equal_words", "item_words", F.size("spans").cast("long").alias("n_spans"),
        F.col("spans")[0]["start"].alias("first_char"), F.element_at("spans", -1)["end"].alias("end_char"))


@query
def op3_line_dedup(spark, d) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, d, "documents")).select("doc_id", "text", "lines_removed")


@query
def op4_warc(spark, d) -> DataFrame:
    path = run_dir(spark, "warc")
    warc.archive(table(spark, d, "pages"), path)
    return warc.restored(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


@query
def op5_embedding(spark, d) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, d, "embeddings"))


@query
def op6_language(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    found = language_id.dictionaries(docs.filter(~language_id.held_out()))
    return language_id.languages(docs, found).select(
        "doc_id", language_id.held_out().alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", "accepted")


@query
def op7_tokens(spark, d) -> DataFrame:
    return token_counts.token_counts(table(spark, d, "documents"))


@query
def op8_quality(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    model = quality.fit(docs, table(spark, d, "labels"), corpus_pipeline.grade())
    return quality.graded(docs.select("doc_id", "text"), model, at_least=2).drop("text")


@query
def op9_simhash(spark, d) -> DataFrame:
    found = simhash.simhash_groups(table(spark, d, "documents"))
    return found.select("doc_id", unsigned_hex("fingerprint").alias("fingerprint"), "component_id")


@query
def op10_sharding(spark, d) -> DataFrame:
    return sharding.placed(table(spark, d, "documents").select("doc_id"), SHARDS)


@query
def op11_exact_dedup(spark, d) -> DataFrame:
    return exact_dedup.deduplicated(spark, f"{d}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query
def op12_phrases(spark, d) -> DataFrame:
    return phrases.collocations(table(spark, d, "documents"))


@query
def op13_ranked_search(spark, d) -> DataFrame:
    return ranked_search.ranked(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def pipeline(spark, d) -> DataFrame:
    return corpus_pipeline.run(spark, d)
