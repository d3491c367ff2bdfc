import math
import random
import re
from collections import Counter
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import STRANGE, WORDS, documents
from stowage.llm import common, ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=10):
    held = [(k, Counter(found(t))) for k, t in docs if found(t)]
    N, L = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for key, counts in held:
            m = 100 - 90 + ((90 * sum(counts.values()) * N) // L)
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
                        for t in set(found(text)) if t in counts)
            if score > 0:
                scores.append((-score, key is not None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def test_terms_like_the_pattern():
    every = "".join(map(chr, range(1, 1200))) + "Ａ日本 x_y-z É é\u0085 \x1c1.5e3"
    assert [t.decode() for t in R.terms(every)] == found(every) and R.terms(None) == R.terms("") == R.terms("...") == []


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(5)
    common, rare = WORDS[:6], [w + str(k) for w in WORDS for k in range(20)]
    rows = list(STRANGE)
    for k in range(900):
        own = [draw.choice(common) for _ in range(draw.randint(1, 60))] + [draw.choice(rare) for _ in range(draw.randint(0, 6))]
        draw.shuffle(own)
        rows.append((1000 + k, draw.choice([" ", ", ", "\n"]).join(w.upper() if draw.random() < 0.1 else w for w in own)))
    rows += [(5000 + k, "stone stone river") for k in range(40)] + [(7000, "river " * 400_000 + "needle0")]
    items = [(k, " ".join([draw.choice(common) for _ in range(draw.randint(0, 4))] + [draw.choice(rare) for _ in range(draw.randint(0, 5))]))
             for k in range(40)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "nobodyhasthis"), (54, "stone river"), (None, "needle0 quiet"), (55, "river"), (55, "river"),
              (56, " ".join(common)), (57, "日本語のテキスト")]
    return rows, items


@pytest.mark.parametrize("shard, item_bytes", [(R.SHARD_DOCUMENTS, R.ITEM_BYTES), (64, 200), (7, 4 << 20)])
def test_like_plain(spark, tables, shard, item_bytes):
    rows, items = tables
    docs = documents(spark, rows).repartition(5).withColumnsRenamed({"fingerprint": "keys", "node": "_item", "start": "rank", "_key": "_score"})
    asked = spark.createDataFrame([(*i, "c", 1) for i in items], "item_id long, text string, doc_id string, score int")
    index = R.index(docs, shard_documents=shard).cache()
    out = R.search(index, asked, item_bytes=item_bytes)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=repr) == plain(rows, items)


def test_more_and_fewer(spark, tables):
    rows, items = tables
    docs, asked = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, R.ranked(docs, asked, top=1).collect()), key=repr) == plain(rows, items, 1)
    assert sorted(map(tuple, R.ranked(docs, asked, top=2000).collect()), key=repr) == plain(rows, items, 2000)


def test_rows_of_one_item_with_different_texts(spark):
    docs = documents(spark, [(1, "a b"), (2, "b c"), (3, "c")])
    asked = spark.createDataFrame([(1, "a"), (1, "c")], "item_id long, text string")
    assert sorted((r.item_id, r["rank"], r.doc_id) for r in R.ranked(docs, asked).collect()) == [(1, 1, 1), (1, 1, 3), (1, 2, 2)]


def test_empty_tables(spark, tables):
    docs, asked = documents(spark, tables[0]), spark.createDataFrame(tables[1], "item_id long, text string")
    for some, them in ((docs.filter("false"), asked), (docs, asked.filter("false")), (docs.filter("text is null"), asked)):
        out = R.ranked(some, them)
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_a_stored_index_is_written_and_read_a_shard_at_a_time(spark, monkeypatch):
    """A row group has one shard and no statistics, which would hold shards until the file is closed."""
    groups = []

    def forget(stored):
        for path in Path(stored.stored_at.removeprefix("file:")).glob("*.parquet"):
            found = pq.ParquetFile(path).metadata
            groups.extend(found.row_group(k) for k in range(found.num_row_groups))

    monkeypatch.setattr(common, "forget", forget)
    monkeypatch.setattr(R, "index", partial(R.index, shard_documents=256))
    docs = [(k, f"river stone word{k % 7}") for k in range(1024)]
    best = R.ranked(documents(spark, docs).coalesce(1), spark.createDataFrame([(1, "word3 river")], "item_id long, text string"))
    assert [(r.rank, r.doc_id) for r in best.orderBy("rank").collect()] == [(k + 1, 3 + 7 * k) for k in range(10)]
    assert [g.num_rows for g in groups] == [1] * 4
    assert not any(g.column(c).is_stats_set for g in groups for c in range(g.num_columns))


def test_skipping_loses_nothing():
    """Any mix of short and long lists, against all sums; and blocks are in fact skipped."""
    draw = np.random.RandomState(2)
    for documents_ in (1, 127, 128, 5000):
        lists = {}
        for term in range(8):
            places = np.flatnonzero(draw.random_sample(documents_) < draw.choice([0.002, 0.02, 0.3, 0.9]))
            lists[term] = R._List(places, draw.randint(1, 40, len(places)).astype(np.int64), documents_)
        weighted = [(int(draw.randint(1, 50)), term) for term in range(8)]
        sums = np.zeros(documents_, np.int64)
        for w, term in weighted:
            sums[lists[term].places] += w * lists[term].quotients
        for least in (1, 500):
            order = sorted((-s, k) for k, s in enumerate(sums.tolist()) if s >= least)[:10]
            assert R.best_places(weighted, lists, documents_, 10, least) == [(-s, k) for s, k in order]


def test_wide_numbers():
    lengths = np.array([1, 10**9, 10**12])
    assert R.length_norms(lengths, 10**11, 10**14).tolist() == [10 + 90 * n * 10**11 // 10**14 for n in (1, 10**9, 10**12)]
