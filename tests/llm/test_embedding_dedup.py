import numpy as np

from stowage.llm import embedding_dedup as E


def plain(rows, cosine=0.98):
    rows = sorted({(i, None if v is None else tuple(v), l) for i, v, l in rows}, key=repr)
    units = []
    for i, v, l in rows:
        good = i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    near = [[a != b and units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
             and rows[a][0] != rows[b][0] and float(units[a] @ units[b]) >= cosine for b in range(len(rows))] for a in range(len(rows))]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(len(rows)):
            if near[a][b]:
                x, y = group[a], group[b]
                group = [min(x, y) if g in (x, y) else g for g in group]
    out = []
    for a, (i, _, _) in enumerate(rows):
        root = min((rows[b][0] for b in range(len(rows)) if group[b] == group[a] and rows[b][0] is not None), default=None)
        out.append((i, sum(near[a]), root, root == i))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, node string, links int")


def rows_of(seed=1, n=120, width=16):
    draw = np.random.RandomState(seed)
    rows = []
    for k in range(n):
        base = draw.normal(size=width)
        for c in range(draw.randint(1, 5)):
            v = (base + draw.normal(size=width) * draw.choice([0, 0.02, 0.1, 0.2, 0.3])).astype(np.float32)
            rows.append((len(rows), [float(x) for x in v], int(draw.randint(3))))
    return rows


STRANGE = [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [0.0] * 16, 1), (9005, [float("nan")] * 16, 1),
           (9006, [float("inf")] + [1.0] * 15, 1), (9007, [None] + [1.0] * 15, 1), (9008, [1.0] * 15, 1), (9009, [1.0] * 16, 1),
           (9010, [2.0] * 16, 1), (9011, [1.0] * 16, None), (9012, [1.0] * 16, None), (9009, [1.0] * 16, 1), (9013, [1e30] * 16, 1),
           (9014, [-0.0] + [1.0] * 15, 2), (9015, [0.0] + [1.0] * 15, 2), (9016, [None] + [1.0] * 15, 1)]


def test_like_all_pairs(spark):
    rows = rows_of() + STRANGE
    out = E.embedding_groups(table(spark, rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=repr) == plain(rows)


def test_one_large_group_in_cells(spark, monkeypatch):
    monkeypatch.setattr(E, "CELL", 16)
    draw = np.random.RandomState(2)
    base = draw.normal(size=16)
    rows = [(k, [float(x) for x in (base + draw.normal(size=16) * 0.08).astype(np.float32)], 0) for k in range(150)]
    rows += [(200 + k, rows[0][1], 0) for k in range(40)]
    out = E.embedding_groups(table(spark, rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=repr) == plain(rows)


def test_empty_table(spark):
    assert E.embedding_groups(table(spark, [])).collect() == []
