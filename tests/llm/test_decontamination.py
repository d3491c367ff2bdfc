import itertools
import random

import pytest
from helpers import STRANGE, WORDS, documents, sentence
from stowage.llm import decontamination as D


def test_seeds_miss_no_pair_of_substitutions():
    for pair in itertools.combinations(range(D.WINDOW), 2):
        assert any(not {s + p for p in seed} & set(pair) for seed in D.SEEDS for s in range(D.WINDOW - seed[-1]))


def plain(texts, items, known={}):
    """Every alignment of every text with every item."""
    if len(texts) == 1:
        if texts[0] not in known:
            known[texts[0]] = plain([*texts, (0, None)], items)
        return known[texts[0]]
    found = {}
    for i, text in texts:
        words = [w.lower() for w in D._WORD.findall(text or "")]
        for j, item in items:
            other = [w.lower() for w in D._WORD.findall(item or "")]
            window = min(D.WINDOW, len(other))
            if not window:
                continue
            wrong = 2 if window == 13 else 1 if window >= 8 else 0
            covered = set()
            for shift in range(-len(other), len(words)):
                pairs = [(k, words[k] == other[k - shift]) for k in range(len(words)) if 0 <= k - shift < len(other)]
                for s in range(len(pairs) - window + 1):
                    if sum(e for _, e in pairs[s:s + window]) >= window - wrong:
                        covered.update(k for k, _ in pairs[s:s + window])
            if covered:
                found[i, j] = len(covered)
    return found


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(4)
    items = [(k, sentence(100 + k, draw.randint(5, 40))) for k in range(12)] + [(50, None), (51, ""), (52, "too short"), (None, sentence(60, 20))]
    texts = list(STRANGE)
    for k in range(40):
        words = sentence(200 + k, 40).split()
        item = draw.choice(items[:12])[1].split()
        start = draw.randint(0, max(0, len(item) - 14))
        part = item[start:start + draw.randint(10, 40)]
        for _ in range(draw.randint(0, 4)):
            part[draw.randrange(len(part))] = draw.choice(WORDS).upper()
        texts.append((100 + k, ", ".join(words[:20] + part + words[20:])))
    texts += [(300, " ".join([sentence(60, 20)] * 3)), (300, sentence(60, 20))]
    # Short items whole, with one word changed, and with two.
    for n in range(1, 13):
        item = [f"{w}{n}" for w in sentence(400 + n, n).split()]
        items.append((100 + n, " ".join(item)))
        for changes in range(3):
            part = list(item)
            for k in draw.sample(range(n), min(n, changes)):
                part[k] = "changed"
            texts.append((1000 + 10 * n + changes, " ".join([*sentence(500 + n, 9).split(), *part, *sentence(600 + n, 9).split()])))
    items += [(50, None), (1 + 100, items[-12][1]), (102, items[-11][1])]
    return texts, items, documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_chars", [D.BLOCK_CHARS, 300])
def test_like_all_alignments(tables, block_chars):
    texts, items, docs, benchmark = tables
    rows = D.contaminations(docs, benchmark, block_chars=block_chars).collect()
    # Several rows may share a key here, so they are compared one by one.
    expected = sorted(((i, j), n) for t in texts for (i, j), n in plain([t], items).items())
    assert sorted((((r.doc_id, r.item_id), r.overlap_words) for r in rows), key=repr) == sorted(expected, key=repr)
    assert len(expected) > 20
    for r in rows:
        assert r.equal_words <= r.overlap_words and all(s.start < s.end for s in r.spans)


def test_clean_documents_stay(spark, tables):
    texts, items, docs, benchmark = tables
    left = D.decontaminated(docs, benchmark)
    assert left.columns == docs.columns
    expected = sorted((t for t in texts if not plain([t], items)), key=repr)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == expected


def test_empty_tables(spark, tables):
    _, _, docs, benchmark = tables
    none = benchmark.filter("false")
    assert D.contaminations(docs, none).count() == 0 and D.decontaminated(docs, none).count() == docs.count()
    assert D.contaminations(docs.filter("false"), benchmark).count() == 0
