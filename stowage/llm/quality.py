"""Graded quality of documents: ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import others

#: Hashed features.
WIDTH = 1 << 18
#: At most so many labelled documents of each grade are fitted on: those with the least hash in each of as many slots.
PER_GRADE = 4096
#: Features of fewer fitted documents than this have no weight.
LEAST_DOCS = 4

_TOKEN = re.compile(r"\w+|[^\w\s]+")


def features(text: str, known: dict) -> set[int]:
    """Hashed features of a whole text: its different words and runs of signs, and a few shares in steps."""
    tokens = _TOKEN.findall(text)
    distinct = set(tokens)
    found = set(map(known.__getitem__, distinct))
    if tokens:
        upper = sum(1 for t in distinct if t.isupper() and len(t) > 1)
        signs = sum(1 for t in tokens if not (t[0].isalnum() or t[0] == "_"))
        shares = (("upper", upper / len(distinct)), ("signs", signs / len(tokens)),
                  ("variety", math.log1p(len(distinct)) / math.log1p(len(tokens))))
        found.update(known[f"\0{name}{int(20 * share)}"] for name, share in shares)
    return found


class _Places(dict):
    """The feature of each token, remembered within bounds."""

    def __missing__(self, token):
        if len(self) > 300_000:
            self.clear()
        value = self[token] = xxhash.xxh64_intdigest(token.lower(), 8) % WIDTH
        return value


@dataclass
class Model:
    """P(grade <= k) = logistic(thresholds[k] - score), one score with shared weights for all grades."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every row and every grade but the greatest."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def fit_model(rows: list[np.ndarray], grades: np.ndarray, totals: dict[int, int] | None = None, steps: int = 600,
              rate: float = 0.3, sparse: float = 3e-4) -> Model:
    """Proximal AdaGrad on the mean negative log-likelihood with an L1 penalty.

    A grade weighs in as its number of labelled documents (``totals``) to the power 0.75, shared by those fitted on:
    rare grades are heard, and frequent ones keep most of their prior.
    """
    levels = sorted(set(grades.tolist()))
    y = np.searchsorted(levels, grades)
    count = np.bincount(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), minlength=WIDTH)
    used = np.nonzero((count >= LEAST_DOCS) | (count >= 0.5 * len(rows)))[0]
    place = np.full(WIDTH, -1)
    place[used] = np.arange(len(used))
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = place[np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)]
    row, column = row[column >= 0], column[column >= 0]
    k, fitted = max(0, len(levels) - 1), np.bincount(y, minlength=len(levels))
    share = np.array([(totals or {}).get(g, n) for g, n in zip(levels, fitted)], float) ** 0.75
    weight = (share / max(share.sum(), 1) / np.maximum(fitted, 1))[y]
    w, cuts = np.zeros(len(used)), np.arange(k) - (k - 1) / 2
    sum_w, sum_c = np.full(len(used), 1e-8), np.full(k, 1e-8)
    for _ in range(steps if k else 0):
        score = np.bincount(row, w[column], len(rows))
        low = np.where(y > 0, cuts[np.maximum(y - 1, 0)], -np.inf) - score
        high = np.where(y < k, cuts[np.minimum(y, k - 1)], np.inf) - score
        at_low, at_high = (1 / (1 + np.exp(-np.clip(x, -40, 40))) for x in (low, high))
        at_low, at_high = np.where(y > 0, at_low, 0.0), np.where(y < k, at_high, 1.0)
        share = np.maximum(at_high - at_low, 1e-12)
        d_low, d_high = at_low * (1 - at_low) / share, at_high * (1 - at_high) / share
        g = np.bincount(column, (weight * (d_high - d_low))[row], len(used))
        g_cut = np.bincount(y, weight * -d_high, k + 1)[:k] + np.bincount(y, weight * d_low, k + 1)[1:]
        sum_w += g * g
        sum_c += g_cut * g_cut
        pace = rate / np.sqrt(sum_w)
        w = w - pace * g
        w = np.sign(w) * np.maximum(np.abs(w) - pace * sparse, 0)
        cuts = np.maximum.accumulate(cuts - rate / np.sqrt(sum_c) * g_cut)
    weights = np.zeros(WIDTH)
    weights[used] = w
    return Model(levels, weights, cuts)


def fit(docs: DataFrame, labels: DataFrame, grade: Column, key: str = "doc_id", text: str = "text",
        per_grade: int = PER_GRADE) -> Model:
    """A model of ``grade`` (an integer column of ``labels``) from at most ``per_grade`` documents of each grade.

    A key labelled several times counts once, with its least grade; null keys, grades and texts are not learned from;
    of several texts of one key the least is taken.
    """
    rated = labels.select(F.col(key).alias("_key"), grade.cast("int").alias("_grade")).dropna().groupBy("_key").agg(
        F.min("_grade").alias("_grade"))
    totals = {r["_grade"]: r["count"] for r in rated.groupBy("_grade").count().collect()}
    draw = F.xxhash64(F.lit(11), "_key")
    chosen = rated.groupBy("_grade", F.pmod(draw, F.lit(per_grade)).alias("_slot")).agg(
        F.min_by("_key", F.struct(draw, "_key")).alias("_key")).select("_key", "_grade")

    def step(batches):
        known = _Places()
        for batch in batches:
            found = [sorted(features(t, known)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["grade", "found"])

    # At most `per_grade` rows a grade are sent to the tasks.
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).dropna().join(F.broadcast(chosen), "_key")
    rows = texts.groupBy("_key", "_grade").agg(F.min("_text").alias("_text")).select("_grade", "_text").mapInArrow(
        step, "grade int, found array<int>").toArrow()
    grades = rows.column("grade").to_numpy()
    lists = rows.column("found").combine_chunks()
    found = np.split(lists.flatten().to_numpy(), lists.offsets.to_numpy()[1:-1] - lists.offsets[0].as_py()) if len(rows) else []
    order = sorted(range(len(found)), key=lambda i: (grades[i], found[i].tobytes()))  # rows come in any order
    return fit_model([found[i] for i in order], grades[order] if len(order) else np.zeros(0, int), totals)


GRADES = "expected_grade double, tail_probability double, accepted boolean"


def graded(docs: DataFrame, model: Model, text: str = "text", at_least: int | None = None, probability: float = 0.5) -> DataFrame:
    """All rows with ``expected_grade``, ``tail_probability`` of a grade of ``at_least`` (the greatest) or more, and ``accepted``.

    Whole texts are graded. A null text, or one without a word or sign, has null grades and is not accepted. A model of
    no grades gives null grades and accepts every other text; a model of a single grade gives that grade with
    probability one. Equal texts get equal results. Input columns with the three names, in any case, are replaced.
    """
    names = [c.split()[0] for c in GRADES.split(", ")]
    kept = docs.select(*[F.col(f"`{c}`") for c in others(docs.columns, *names)])
    held = docs.sparkSession.sparkContext.broadcast((model.grades, model.weights, model.thresholds))
    lowest = at_least if at_least is not None else max(model.grades, default=0)
    place, out = kept.columns.index(text), [*kept.columns, *names]

    def step(batches):
        model, known = Model(*held.value), _Places()
        grades = np.array(model.grades, float)
        for batch in batches:
            score, some = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for k, t in enumerate(batch.column(place)):
                found = features(t.as_py(), known) if t.is_valid else ()
                if found:
                    score[k], some[k] = model.weights[sorted(found)].sum(), True
            if len(grades):
                above = model.above(score)
                expected = grades[0] + above @ np.diff(grades)
                below = int((grades < lowest).sum())
                tail = np.ones(len(score)) if not below else above[:, below - 1] if below < len(grades) else np.zeros(len(score))
                accepted = some & (tail >= probability)
            else:
                expected = tail = np.full(len(score), np.nan)
                accepted = some
            null = ~some if len(grades) else np.ones(len(score), bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(expected, mask=null), pa.array(tail, mask=null), pa.array(accepted)],
                names=out)

    schema = kept.withColumns({n: F.lit(None).cast(t) for n, t in (c.split() for c in GRADES.split(", "))}).schema
    return kept.mapInArrow(step, schema)
