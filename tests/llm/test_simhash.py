import math
import random

import numpy as np
import pytest
import xxhash
from helpers import STRANGE, documents, sentence
from pyspark.sql import functions as F

from stowage.llm import simhash as S
from stowage.llm.common import components
from stowage.llm.queries import op9_simhash


def plain_fingerprint(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", lowered)]
    if not words:
        return 0
    runs = [" ".join(words[k:k + n]) for k in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(keys, linked):
    group = {k: k for k in range(len(keys))}
    for a in range(len(keys)):
        for b in range(a):
            if linked(a, b) and group[a] != group[b]:
                x, y = group[a], group[b]
                group = {k: x if g == y else g for k, g in group.items()}
    least = {}
    for k, g in group.items():
        if keys[k] is not None:
            least[g] = min(least.get(g, keys[k]), keys[k])
    return [least.get(group[k]) for k in range(len(keys))]


def altered(text, changes, seed):
    draw, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = draw.choice(["other", "changed", "words"])
    return " ".join(words)


def corpus():
    rows = list(STRANGE)
    for k in range(40):
        base = sentence(500 + k, 40 + 10 * (k % 30))
        rows += [(100 + 10 * k + c, altered(base, c, c)) for c in range(k % 6)]
    return rows


def test_fingerprints_and_groups(spark):
    rows = corpus()
    out = S.simhash_groups(documents(spark, rows)).collect()
    marks = [plain_fingerprint(t) for _, t in rows]
    least = plain_groups([i for i, _ in rows], lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    assert sorted(((r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in out), key=repr) == sorted(
        [(i, m, c) for (i, _), m, c in zip(rows, marks, least)], key=repr)
    assert len({c for c in least}) < len(rows) - 20


@pytest.mark.parametrize("max_bits,parts,cell", [(3, (2,), 2048), (3, (3,), 4), (3, (4,), 4), (7, (3, 4, 5), 8), (3, (2, 3, 4), 2)])
def test_no_link_is_lost(spark, monkeypatch, max_bits, parts, cell):
    """Fingerprints around a few centres with biased bits, hot blocks dealt to cells."""
    monkeypatch.setattr(S, "CELL", cell)
    if parts == (4,):  # more hot blocks than go to all tasks
        monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    draw = np.random.RandomState(max_bits)
    centres = [sum(1 << b for b in range(64) if draw.rand() < (0.9 if b % 2 else 0.3)) for _ in range(12)]
    values = sorted({c ^ sum(1 << b for b in set(draw.randint(0, 64, draw.randint(0, 7)).tolist())) for c in centres for _ in range(12)})
    points = spark.createDataFrame([(k, v - (v >> 63 << 64), 10) for k, v in enumerate(values)], "node long, fp long, size int")
    expected = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if (values[a] ^ values[b]).bit_count() <= max_bits}
    tree = {r.node: r.root for r in components(S.near_links(points, max_bits, parts)).collect()}
    assert [tree.get(k, k) for k in range(len(values))] == plain_groups(
        list(range(len(values))), lambda a, b: (min(a, b), max(a, b)) in expected)
    # With a check that leaves few pairs, every pair that could connect something has to be tried.
    holds = {(a, b) for a, b in expected if (a * 7 + b * 13) % 5 == 0}
    tried = []

    def verify(pairs, later):
        got = [tuple(r) for r in pairs.collect()]
        assert set(got) <= expected
        tried.append(len(got))
        return spark.createDataFrame([p for p in got if p in holds], "a long, b long")

    tree = {r.node: r.root for r in S.verified_groups(points, max_bits, parts, 0.0, verify, rounds=(1, 2)).collect()}
    assert [tree.get(k, k) for k in range(len(values))] == plain_groups(
        list(range(len(values))), lambda a, b: (min(a, b), max(a, b)) in holds)


def test_thresholds_are_the_cheapest():
    cost, chosen = S.allocate([[0, 5, 50], [0, 1, 2], [0, 9, 9]], 0)
    assert (cost, chosen) == (7, [0, 1, -1])


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = list(range(400))
    for a, b in edges:
        x, y = group[a], group[b]
        group = [min(x, y) if g in (x, y) else g for g in group]
    assert got == {k: group[k] for e in edges for k in e if e[0] != e[1] or k in got}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def jaccard(a, b, n=5):
    def runs(t):
        words = (t or "").lower().split()
        return {" ".join(words[k:k + n]) for k in range(len(words) - n + 1)} or ({" ".join(words)} if words else set())
    x, y = runs(a), runs(b)
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def test_one_document_of_each_group(spark):
    rows = corpus()
    docs = documents(spark, rows)
    out = S.unique_documents(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    # What stays has no near duplicate left; what went has one in its group.
    marks = [int(S.fingerprint(np.unique(S.shingle_hashes(t, 2)))) for _, t in rows]
    least = plain_groups([(i is None, i or 0) for i, _ in rows], lambda a, b: jaccard(rows[a][1], rows[b][1]) >= 0.8 and (marks[a] ^ marks[b]).bit_count() <= 7)
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in kept)) == sorted(set(least))


def test_a_large_group_is_connected_through_its_first_members(spark):
    points = spark.createDataFrame([(k, (1 << (k % 40)) - (1 << 62), 10) for k in range(400)], "node long, fp long, size int")
    tried = []

    def verify(pairs, later):
        tried.append(pairs.count())
        return pairs

    assert {r.root for r in S.verified_groups(points, 7, (3, 4, 5), 0.8, verify).collect()} == {0}
    assert sum(tried) < 400 * 60  # of 79,800 pairs


def test_many_copies_and_empty_table(spark):
    rows = [(k % 40, sentence(1, 50)) for k in range(400)] + [(1000 + k, None) for k in range(50)]
    assert sorted(r.doc_id for r in S.unique_documents(documents(spark, rows)).collect()) == [0, 1000]
    assert S.unique_documents(documents(spark, [])).collect() == []
    assert S.simhash_groups(documents(spark, [])).collect() == []


def test_query(spark, sf_dir):
    rows = op9_simhash(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(r.fingerprint == f"{plain_fingerprint(texts[r.doc_id]):016x}" for r in rows) and len(rows) == len(texts)


def test_parity_sketches_reject_no_pair_that_is_alike():
    draw = np.random.RandomState(3)
    rejected = 0
    for k in range(400):
        size = int(draw.randint(1, 400))
        common = draw.randint(0, 2**64, size, np.uint64)
        own = [draw.randint(0, 2**64, int(draw.randint(0, 1 + size // 2)), np.uint64) for _ in "ab"]
        a, b = (np.unique(np.concatenate([common, x])) for x in own)
        both = len(np.intersect1d(a, b))
        odd = [np.array(x) for x in zip(S.parities(a), S.parities(b))]
        assert sum(int(x[0] ^ x[1]).bit_count() for x in odd) <= len(a) + len(b) - 2 * both
        near = list(S._near(np.zeros(2, int), np.array([0, 1]), None, np.zeros(2, np.uint64), np.array([len(a), len(b)], np.int32),
                            np.array([0, 1]), 7, 0.8, odd))
        found = sum(len(x) for x, _ in near)
        if both >= 0.8 * (len(a) + len(b) - both):
            assert found == 1
        else:
            rejected += 1 - found
    assert rejected > 150
    assert not S.parities(np.zeros(0, np.uint64)).any()


def test_texts_of_one_mould_are_rejected_where_they_are_found(spark, monkeypatch):
    """Near by their fingerprints, but not alike: the pairs do not reach the exact check."""
    rows, seen, whole = [(k, sentence(1, 60) + " " + sentence(100 + k, 30)) for k in range(60)], [], S.verified_groups

    def counted(points, max_bits, parts, similarity, verify):
        def check(pairs, later):
            seen.append(pairs.count())
            return verify(pairs, later)
        return whole(points, max_bits, parts, similarity, check)

    monkeypatch.setattr(S, "verified_groups", counted)
    assert S.unique_documents(documents(spark, rows), max_bits=20, parts=(18,)).count() == 60
    assert sum(seen) < 60


def copies_of_kinds(number=30):
    """By kind, pairs of a text and a copy whose Jaccard similarity is 0.8 or a little more."""
    kinds = {k: [] for k in ("appended", "truncated", "put in front", "substituted", "short")}
    for k in range(number):
        draw, base = random.Random(k), [f"w{random.Random(10_000 * k + n).randrange(10**6)}" for n in range(60 + 17 * k)]
        further = [f"v{draw.randrange(10**6)}" for _ in range(int((len(base) - 4) * 0.25))]
        swapped = list(base)
        for n in range(len(base) // 50):
            swapped[25 + 50 * n] = "other"
        kinds["appended"].append((base, base + further))
        kinds["truncated"].append((base, base[:4 + math.ceil((len(base) - 4) * 0.8)]))
        kinds["put in front"].append((base, further + base))
        kinds["substituted"].append((base, swapped))
        kinds["short"].append((base[:14], base[:13]))
    return {kind: [(" ".join(a), " ".join(b)) for a, b in pairs] for kind, pairs in kinds.items()}


@pytest.mark.parametrize("cell", [2048, 4])
def test_every_kind_of_copy_goes_by_jaccard_alone(spark, monkeypatch, cell):
    monkeypatch.setattr(S, "CELL", cell)
    kinds = copies_of_kinds()
    pairs = [p for found in kinds.values() for p in found]
    # Half of them no fingerprint search at seven bits would find.
    marks = [[S.fingerprint(np.unique(S.shingle_hashes(t, 2))) for t in p] for p in pairs]
    assert all(jaccard(a, b) >= 0.8 for a, b in pairs) and sum((a ^ b).bit_count() > 7 for a, b in marks) > 40
    for kind, found in kinds.items():
        rows = [(2 * k + side, t) for k, p in enumerate(found) for side, t in enumerate(p)]
        assert sorted(r.doc_id for r in S.unique_documents(documents(spark, rows)).collect()) == list(range(0, len(rows), 2)), kind
    rows = corpus()
    least = plain_groups([(i is None, i or 0) for i, _ in rows], lambda a, b: jaccard(rows[a][1], rows[b][1]) >= 0.8)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in S.unique_documents(documents(spark, rows)).collect()) == sorted(set(least))


def test_bands_agree_by_similarity_alone():
    draw, drawn = np.random.RandomState(8), S.permutations(0.8)
    for common, left, right in [(80, 0, 20), (80, 20, 0), (80, 10, 10), (800, 0, 200), (8, 1, 1)]:
        agree = []
        for _ in range(200):
            x, y, z = (draw.randint(0, 2**64, n, np.uint64) for n in (common, left, right))
            agree.append(np.mean(S.band_values(np.concatenate([x, y]), drawn) == S.band_values(np.concatenate([x, z]), drawn)))
        assert abs(np.mean(agree) - 0.8 ** S.BAND) < 0.03 and min(agree) > 0
    assert not len(S.band_values(np.zeros(0, np.uint64), drawn)) and len(S.band_values(np.arange(3, dtype=np.uint64), S.permutations(1.0))) == 1


def test_texts_of_one_mould_are_rejected_by_their_bands(spark, monkeypatch):
    rows, seen, whole = [(k, sentence(1, 60) + " " + sentence(100 + k, 30)) for k in range(60)], [], S.verified_groups

    def counted(points, max_bits, parts, similarity, verify):
        assert "bands" in points.columns
        def check(pairs, later):
            seen.append(pairs.count())
            return verify(pairs, later)
        return whole(points, max_bits, parts, similarity, check)

    monkeypatch.setattr(S, "verified_groups", counted)
    assert S.unique_documents(documents(spark, rows)).count() == 60
    assert sum(seen) < 60


def test_fingerprints_are_searched_first_and_bands_take_the_rest(spark, monkeypatch):
    """Copies by both kinds of search: each pair at three bits comes from the fingerprints, what they lose from the bands."""
    pairs = [tuple(" ".join(f"{w}{kind[:3]}" for w in text.split()) for text in p) for kind, found in copies_of_kinds(8).items() for p in found]
    rows, searched, cells = [(2 * k + side, t) for k, p in enumerate(pairs) for side, t in enumerate(p)], [], S._cells

    def counted(points, max_bits, parts):
        searched.append((("fp" if "fp" in points.columns else "bands"), max_bits))
        return cells(points, max_bits, parts)

    monkeypatch.setattr(S, "_cells", counted)
    marks = [[S.fingerprint(np.unique(S.shingle_hashes(t, 2))) for t in p] for p in pairs]
    near = {2 * k + 1 for k, (a, b) in enumerate(marks) if (a ^ b).bit_count() <= 3}
    assert 1 < len(near) < len(pairs) - 1
    assert sorted(r.doc_id for r in S.unique_documents(documents(spark, rows)).collect()) == list(range(0, len(rows), 2))
    assert searched == [("fp", 3), ("bands", 3)]
    left = {r.doc_id for r in S.unique_documents(documents(spark, rows), bands=False).collect()}
    assert left == {k for k, _ in rows} - near
