import random

from helpers import STRANGE, documents
from stowage.llm import line_dedup


def plain(rows, window=3):
    """Rows equal in key and text are one document; the first occurrence of a passage stays."""
    seen, out = {}, []
    order = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    gone = {}
    for row in order:
        lines = row[1].split("\n")
        for k in range(len(lines) - window + 1):
            passage = tuple(lines[k:k + window])
            if not "".join(x.strip(" ") for x in passage):
                continue
            if seen.setdefault(passage, (row, k)) != (row, k):
                gone.setdefault(row, set()).update(range(k, k + window))
    for row in rows:
        lost = gone.get(row, set())
        text = None if row[1] is None else "\n".join(x for k, x in enumerate(row[1].split("\n")) if k not in lost)
        out.append((row[0], text, len(lost)))
    return sorted(out, key=repr)


def test_like_plain(spark):
    draw = random.Random(3)
    rows = list(STRANGE)
    for k in range(80):
        rows.append((100 + k, "\n".join(draw.choice(["a", "b", "", " ", "line\twith", "é"]) + str(draw.randrange(4)) * draw.randrange(2)
                                        for _ in range(draw.randrange(1, 30)))))
    rows += rows[20:25]
    docs = documents(spark, rows).withColumnRenamed("shard", "Lines_Removed")
    out = line_dedup.dedup_lines(docs)
    assert [c for c in out.columns if c != "lines_removed"] == [c for c in docs.columns if c != "Lines_Removed"]
    assert sorted(((r.doc_id, r.text, r.lines_removed) for r in out.collect()), key=repr) == plain(rows)


def test_a_passage_in_every_document(spark):
    rows = [(k, f"own {k}\n1\n2\n3\n4\nend {k}") for k in range(300)]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert out[0] == rows[0][1] and all(out[k] == f"own {k}\nend {k}" for k in range(1, 300))


def test_empty_table(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).collect() == []
