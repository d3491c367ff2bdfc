import numpy as np
from helpers import STRANGE, documents, sentence
from pyspark.sql import functions as F

from stowage.llm import quality as Q
from stowage.llm.queries import op8_quality


def test_held_out_documents(spark):
    """Fitted on two thirds of the labels, tried on the rest."""
    folder = "/root/testdata/sf0.1"
    from corpus_pipeline import grade

    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("grade", grade())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    learned, tried = labels.filter("doc_id % 3 > 0"), labels.filter("doc_id % 3 = 0")
    rows = Q.graded(docs.join(tried, "doc_id"), Q.fit(docs, learned, F.col("grade")), at_least=2).collect()
    accepted = {g: np.mean([r.accepted for r in rows if r.grade == g]) for g in (0, 1, 2)}
    assert accepted[0] <= 0.06 and accepted[1] <= 0.06 and accepted[2] >= 0.97
    ranks = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)]
    assert ranks[0] < ranks[1] < ranks[2]


def test_gradient_finds_the_optimum():
    """Tiny data whose best thresholds are known: shares 1/4, 1/4, 1/2 and no features."""
    model = Q.fit_model([np.zeros(0, int)] * 4, np.array([0, 1, 2, 2]), {0: 1, 1: 1, 2: 1}, steps=4000)
    weights = np.ones(3) / 3
    above = model.above(np.zeros(1))[0]
    assert np.allclose(above, [1 - weights[0], weights[2]], atol=0.02)


def test_no_step_betters_the_fit():
    """Against the objective written out plainly: no change of a weight or threshold betters it by more than a trifle."""
    draw = np.random.RandomState(3)
    rows = [np.flatnonzero(draw.random_sample(6) < 0.5) for _ in range(60)]
    score = np.array([r.size and (r == 0).any() * 2.0 - (r == 3).any() * 1.5 for r in rows], float) + draw.normal(0, 0.8, 60)
    grades = np.digitize(score, [-0.7, 0.9])
    model = Q.fit_model(rows, grades, steps=6000)
    totals = np.bincount(grades)
    weight = (totals ** 0.75 / (totals ** 0.75).sum() / totals)[grades]

    def objective(w, cuts):
        total = 0.0
        for r, y, v in zip(rows, grades, weight):
            edges = [0.0, *(1 / (1 + np.exp(-(c - w[r].sum()))) for c in cuts), 1.0]
            total -= v * np.log(edges[y + 1] - edges[y])
        return total + 3e-4 * np.abs(w).sum()

    w, cuts = model.weights[:6].copy(), model.thresholds.copy()
    least = objective(w, cuts)
    assert least < objective(np.zeros(6), cuts) - 0.05
    for x in (w, cuts):
        for k in range(len(x)):
            for move in (-0.5, -0.1, -0.02, 0.02, 0.1, 0.5):
                x[k] += move
                assert np.any(np.diff(cuts) <= 0) or objective(w, cuts) > least - 1e-3
                x[k] -= move


def test_strange_texts(spark):
    docs = documents(spark, STRANGE).withColumnsRenamed({"node": "Expected_Grade", "accepted": "Accepted"})
    labels = spark.createDataFrame([(1, 2), (8, 0), (8, 1), (7, 2), (None, 1), (5, None), (2, 1), (999, 0)], "doc_id long, grade int")
    model = Q.fit(docs, labels, F.col("grade"))
    assert model.grades == [0, 2]
    rows = Q.graded(docs, model).collect()
    assert len(rows) == len(STRANGE)
    for r in rows:
        assert (r.expected_grade is None) == (not (r.text or "").strip()) and r.doc_id in {i for i, _ in STRANGE}
        assert r.tail_probability is not None or not r.accepted
    same = {(r.expected_grade, r.tail_probability) for r in rows if r.text == sentence(1, 60)}
    assert len(same) == 1


def test_degenerate_labels(spark):
    docs = documents(spark, STRANGE)
    none = spark.createDataFrame([], "doc_id long, grade int")
    rows = Q.graded(docs, Q.fit(docs, none, F.col("grade"))).collect()
    assert all(r.expected_grade is None and r.accepted == bool((r.text or "").strip()) for r in rows)
    one = spark.createDataFrame([(1, 2), (7, 2)], "doc_id long, grade int")
    rows = Q.graded(docs, Q.fit(docs, one, F.col("grade"))).collect()
    assert all(r.expected_grade == 2 and r.tail_probability == 1 for r in rows if (r.text or "").strip())
    assert Q.graded(documents(spark, []), Q.fit(docs, one, F.col("grade"))).collect() == []


def test_query(spark, sf_dir):
    rows = op8_quality(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
