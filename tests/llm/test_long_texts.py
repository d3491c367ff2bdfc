"""Texts of several megabytes, through every operator on texts and every stage."""

import random
import tempfile

import numpy as np
import pytest

import corpus_pipeline
from helpers import WORDS, documents
from stowage.llm import (decontamination, exact_dedup, language_id, line_dedup, packing, phrases, quality, ranked_search, sharding,
                         simhash, token_counts, warc)


@pytest.fixture(scope="module")
def long():
    draw = random.Random(1)
    words = [draw.choice(WORDS) + draw.choice(["", "s", "ed"]) for _ in range(500_000)]
    return "\n".join(" ".join(words[k:k + 20]) for k in range(0, len(words), 20))


@pytest.fixture(scope="module")
def docs(spark, long):
    rows = [(1, long), (2, long), (3, long + " more"), (4, "x" * 3_000_000), (5, "short text"), (6, None)]
    return documents(spark, rows).repartition(3).cache()


def test_packing(docs, long):
    rows = packing.pack(docs).collect()
    assert {r.doc_id for r in rows} == set(range(1, 7)) and max(r.length for r in rows) == packing.LENGTH
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert tokens[1] == tokens[2] == tokens[3] - 1 >= len(long.split())
    assert sum(r.length for r in rows if r.doc_id == 1) == tokens[1] and tokens[6] == 1


def test_decontamination(spark, docs, long):
    at = len(long) - 400
    benchmark = spark.createDataFrame([(1, long[at:at + 300]), (2, "nobody says this at all " * 4)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, benchmark).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_line_dedup(docs, long):
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert rows[1].text == long and rows[2].text == "" and rows[4].text == "x" * 3_000_000


def test_marks(docs, long):
    assert {r.doc_id: r.lang_best for r in language_id.languages(docs, {"en": " ".join(WORDS).encode() * 9, "xx": b"qj zv kw " * 200}).collect()}[1] == "en"
    counts = {r.doc_id: r for r in token_counts.token_counts(docs).collect()}
    assert len(counts) == 6 and counts[1][1:] == counts[2][1:]
    model = quality.Model([0, 1], np.zeros(quality.WIDTH), np.zeros(1))
    assert all((r.expected_grade is None) == (r.doc_id == 6) for r in quality.graded(docs, model).collect())
    assert sharding.placed(docs, ["a", "b"]).count() == 6


def test_duplicates(docs):
    found = {r.doc_id: r.component_id for r in simhash.simhash_groups(docs).collect()}
    assert found[1] == found[2] == found[3] == 1 and found[5] == 5
    assert {r.doc_id for r in simhash.unique_documents(docs).collect()} >= {1, 4, 5} and simhash.unique_documents(docs).count() == 4


def test_archive(spark, long):
    path = tempfile.mkdtemp(prefix="warc-")
    warc.archive(spark.createDataFrame([(1, "u", long), (2, "v", long)], "page_id long, url string, html string"), path)
    rows = {r.page_id: r for r in warc.restored(spark, path).collect()}
    assert bytes(rows[1].payload) == bytes(rows[2].payload) == long.encode() and rows[1].refers_to == "2"


def test_streams_phrases_and_search(spark, docs, long):
    path = tempfile.mkdtemp(prefix="long-") + "/documents.parquet"
    docs.write.parquet(path)
    assert {r.doc_id: r.keep_id for r in exact_dedup.deduplicated(spark, path).collect()} == {1: 2, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}
    rows = phrases.collocations(docs, least=100).collect()
    assert rows and all(r.n == 3 * 500_000 + 4 for r in rows)
    items = spark.createDataFrame([(1, "more " + WORDS[0]), (2, "x" * 3_000_000)], "item_id long, text string")
    found = {(r.item_id, r["rank"]): r.doc_id for r in ranked_search.ranked(docs, items).collect()}
    assert found[1, 1] == 3 and found[2, 1] == 4


def test_stages(spark, docs, sf_dir):
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = whole.unionByName(docs.select(*whole.columns).withColumn("doc_id", docs.doc_id + 10**9))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, some, sf_dir).count() > 0, name
