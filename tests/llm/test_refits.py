"""The two classifiers against plain refits: the same features and pairs, solved by Newton steps in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from epigauge.llm import quality, toxicity
from epigauge.llm.common import table

SF = "/root/testdata/sf0.001"


def logistic(x, y, weight, ridge, intercept):
    """Minimum of the weighted mean logistic loss plus half the ridge times the squared coefficients."""
    x = np.column_stack([x, np.ones(len(x))]) if intercept else x
    ridge = np.append(ridge, 0.0) if intercept else ridge
    beta, share = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (share * (p - y)) + ridge * beta
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-12), gradient)
        beta -= step * min(1.0, 20 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return beta


def labelled(spark, name):
    """Texts and labels by id, and all texts."""
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    known = {r["doc_id"]: r[name] for r in table(spark, SF, "labels").collect() if r[name] is not None and r["doc_id"] in docs}
    return docs, known


def test_quality_equals_a_refit_on_the_same_pairs(spark):
    docs, known = labelled(spark, "quality")
    model = quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    classes = quality._class_matrix()
    shapes = {i: quality.shape(docs[i], classes) for i in known}
    rows = [(i, label, shapes[i].tolist()) for i, label in known.items()]
    counts = {label: sum(v == label for v in known.values()) for label in (0, 1)}
    frame = spark.createDataFrame(rows, "doc_id long, label int, features array<double>")
    pairs = quality.preference_pairs(frame, counts).collect()
    x = np.array([np.subtract(p["won"], p["lost"]) for p in pairs])
    # Both directions of every pair: the same loss as one, and features without a mean.
    both = np.concatenate((x, -x))
    y = np.repeat([1.0, 0.0], len(x))
    turned = np.array([r[0] for r in spark.createDataFrame([(p["won"], p["lost"]) for p in pairs], "won array<double>, lost array<double>").select(F.xxhash64("won", "lost") % 2 == 0).collect()])
    deviation = np.where(turned[:, None], -x, x).std(axis=0, ddof=1)
    beta = logistic(both, y, np.ones(len(both)), 1e-4 * deviation**2, intercept=False)
    strength = {i: s @ beta for i, s in shapes.items()}
    cut = np.quantile(list(strength.values()), counts[0] / len(known))
    want = {i: 1 / (1 + np.exp(-np.clip(quality.shape(t, classes) @ beta - cut, -500, 500))) for i, t in docs.items()}
    got = {r["doc_id"]: r["s"] for r in table(spark, SF, "documents").select("doc_id", model.score(F.col("text")).alias("s")).collect()}
    assert max(abs(got[i] - want[i]) for i in docs) < 0.02


def test_toxicity_equals_a_refit_on_the_same_counts(spark):
    docs, known = labelled(spark, "toxic")
    model = toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    label = np.array(list(known.values()))
    grams = [np.unique(toxicity.bins(docs[i]), return_counts=True) for i in known]
    there = np.zeros((2, 1 << toxicity.BITS))
    for (values, _), kind in zip(grams, label, strict=True):
        there[kind, values] += 1
    total = np.array([(label == 0).sum(), (label == 1).sum()], float)
    b, a = there
    ratio = np.log((a + 1) / (total[1] + 2)) - np.log((b + 1) / (total[0] + 2))

    def part(here, of, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(here > 0, here * np.log(here * total.sum() / (of * n)), 0.0)

    absent = total.sum() - a - b
    tells = part(a, a + b, total[1]) + part(b, a + b, total[0]) + part(total[1] - a, absent, total[1]) + part(total[0] - b, absent, total[0])
    tells[a + b <= 1] = -np.inf
    best = np.lexsort((np.arange(len(tells)), -tells.round(9)))[: toxicity.FEATURES]
    assert len(set(best.tolist()) & set(model.chosen.tolist())) >= 0.98 * toxicity.FEATURES
    chosen = model.chosen
    np.testing.assert_allclose(ratio[chosen] == 0, model.weights == 0)

    def scaled(values, times):
        row = np.zeros(1 << toxicity.BITS)
        row[values] = np.log2(1.0 + times)
        return row[chosen] * ratio[chosen]

    x = np.array([scaled(*g) for g in grams])
    weight = np.where(label == 1, toxicity.WEIGHT, 1.0)
    beta = logistic(x, label.astype(float), weight, np.full(x.shape[1], 1e-3), intercept=True)
    got = {r["doc_id"]: r["s"] for r in table(spark, SF, "documents").select("doc_id", model.score(F.col("text")).alias("s")).collect()}
    away = []
    for i, text in docs.items():
        sure = scaled(*np.unique(toxicity.bins(text), return_counts=True)) @ beta[:-1] + beta[-1]
        away.append(abs(got[i] - 1 / (1 + np.exp(-np.clip(sure, -500, 500)))))
    # The library's solver stops a little before the minimum.
    assert max(away) < 0.1 and np.mean(away) < 0.01
