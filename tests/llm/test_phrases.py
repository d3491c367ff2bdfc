import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import STRANGE, WORDS
from stowage.llm import phrases as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, longest):
    """Exact counts of all phrases of (lang, text) rows, and of all words."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return counts, totals


def plain(rows, least, longest=5, top=2000):
    counts, totals = counted(rows, longest)
    found = {p: c for p, c in counts.items() if c >= least}
    scored = {}
    for (lang, words), a in found.items():
        if len(words) < 2 or any(
                100 * c >= 100 * a and len(other) > len(words) and any(other[i:i + len(words)] == words for i in range(len(other)))
                for (l2, other), c in found.items() if l2 == lang):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        scored.setdefault(lang, []).append(
            (-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, totals[lang], -s)
                  for lang, own in scored.items() for rank, (s, a, p, l, r) in enumerate(sorted(own)[:top], 1))


def corpus(seed, n=500):
    draw = random.Random(seed)
    fixed = [[draw.choice(WORDS) for _ in range(draw.randint(2, 9))] for _ in range(30)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(draw.randint(0, 12)):
            words += draw.choice(fixed) if draw.random() < 0.6 else [draw.choice(WORDS) + draw.choice(["", "x", "É"])]
            words.append(draw.choice(["", "", "\t", ",", ".", "\n", " ;"]))
        text = " ".join(words)
        rows.append((draw.choice(["en", "en", "de", None, "und"]), text.upper() if draw.random() < 0.2 else text))
    return rows


ROWS = [*corpus(1), *[("en", t) for _, t in STRANGE], ("en", None), ("fr", ""), ("fr", "..."), ("es", "le \x1c le \x85 le le le " * 30),
        ("de", "sehr lang " * 200_000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k if k % 17 else None, text, lang, "p", 1, 2, 3) for k, (lang, text) in enumerate(ROWS)],
                                 "doc_id long, text string, lang string, phrase string, n int, words int, rank int").repartition(3)


@pytest.mark.parametrize("least, longest, sample", [(20, 5, 8), (20, 5, 1), (5, 5, 2), (30, 3, 4), (20, 2, 8)])
def test_like_plain(docs, least, longest, sample):
    out = P.collocations(docs, least=least, longest=longest, sample=sample)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = plain(ROWS, least, longest)
    assert sorted(map(tuple, out.collect())) == expected and len(expected) > 20


def test_top(docs):
    assert sorted(map(tuple, P.collocations(docs, least=20, top=3).collect())) == plain(ROWS, 20, top=3)


@pytest.mark.parametrize("lowered, passes", [(0.0, 1), (1000.0, 2)])
def test_border(docs, lowered, passes):
    """A sample that is the whole table proposes all; one that proposes nothing leaves all to the border and the further pass."""
    found, made = P.frequent_phrases(docs, least=20, sample=1, lowered=lowered)
    counts, totals = counted(ROWS, 5)
    assert made == passes
    assert {(r.lang, r.phrase): r.n for r in found.filter("words > 0").collect()} == {(l, " ".join(w)): c for (l, w), c in counts.items() if c >= 20}
    assert {r.lang: r.n for r in found.filter("words = 0").collect()} == {**totals, "fr": 0}


def test_a_full_filter_changes_nothing(docs, monkeypatch):
    """With far more phrases than bits, others are counted too, and the result is the same."""
    monkeypatch.setattr(P, "filter_of", lambda phrases, size=8, make=P.filter_of: make(phrases, size))
    assert sorted(map(tuple, P.collocations(docs, least=20).collect())) == plain(ROWS, 20)


def test_chunks(docs):
    rule = P.Pairs()
    whole, parts = ({tuple(r)[:4]: r.n for r in P.phrase_counts(docs, rule, chunk=c).collect()} for c in (P.CHUNK, 50))
    assert whole == parts


def test_counts_by_hash_are_those_by_name(docs):
    """Of all words and pairs, each by its own hash."""
    counts, _ = counted(ROWS, 2)
    by_hash = {int(P.phrase_hash(lang, " ".join(words)).view(np.int64)[0]): c for (lang, words), c in counts.items()}
    rows = P.phrase_counts(docs, P.Pairs()).filter("words > 0").collect()
    assert {r.hash: r.n for r in rows} == by_hash and all(r.phrase == r.lang == "" for r in rows)


def test_wide_products(spark):
    """1000 a n and l r beyond 64 bits."""
    row = spark.sql("SELECT (1000BD * CAST(a AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0))) div (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0))) AS s"
                    " FROM VALUES (90000000000L, 70000000000001L, 3000000000007L, 1000000000009L) AS t(a, n, l, r)").first()
    assert row.s == 1000 * 90000000000 * 70000000000001 // (3000000000007 * 1000000000009)


def test_hashes_of_phrases():
    words = np.array([P.xxhash.xxh64_intdigest(w) for w in "a b c".split()], np.uint64)
    one = P._longer(P._longer(P._first(words[:1], "en"), words[1:2]), words[2:])
    assert P.phrase_hash("en", "a b c") == one and P.phrase_hash("de", "a b c") != one != P.phrase_hash("en", "b a c")


def test_empty_tables(docs):
    for some in (docs.filter("false"), docs.filter("text is null")):
        assert P.collocations(some).collect() == []
