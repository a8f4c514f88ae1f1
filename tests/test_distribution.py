"""Histogram and density against plain Python."""

from __future__ import annotations

import math
import random
import statistics

import pytest

from epigauge.operators.distribution import density, histogram


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "score double")


def test_histogram_equals_numpy(spark):
    numpy = pytest.importorskip("numpy")
    rnd = random.Random(1)
    values = [rnd.gauss(50, 10) for _ in range(500)]
    got = histogram(frame(spark, [*values, None, float("nan")]), "score").orderBy("bin").collect()
    counts, edges = numpy.histogram(values, bins=30)
    assert [r.n for r in got] == counts.tolist()
    assert [r.lower_bound for r in got] == pytest.approx(edges[:-1].tolist())
    assert got[-1].upper_bound == pytest.approx(edges[-1])


def test_histogram_of_equal_scores(spark):
    got = histogram(frame(spark, [5.0] * 7), "score").collect()
    assert sum(r.n for r in got) == 7 and len(got) == 30
    assert min(r.lower_bound for r in got) == pytest.approx(4.5)


@pytest.mark.parametrize("values", [[5.0] * 7, [5.0], []])
def test_density_of_equal_scores(spark, values):
    odd = [*values, None, float("nan"), float("inf")]
    got = density(frame(spark, odd), "score", points=11).orderBy("point").collect()
    if not values:
        assert got == []
        return
    h = len(values) ** -0.2
    assert [r["at"] for r in got] == pytest.approx([4.5 + i / 10 for i in range(11)])
    for r in got:
        assert r.density == pytest.approx(math.exp(-0.5 * ((r["at"] - 5) / h) ** 2) / (h * math.sqrt(2 * math.pi)))


def test_infinite_scores_have_no_bin(spark):
    got = histogram(frame(spark, [1.0, 2.0, float("inf"), -float("inf")]), "score").collect()
    assert sum(r.n for r in got) == 2 and all(math.isfinite(r.lower_bound) for r in got)


def test_density_equals_the_sum_of_kernels(spark):
    rnd = random.Random(2)
    values = [rnd.uniform(1, 100) for _ in range(80)] + [42.0] * 40
    h = statistics.stdev(values) * len(values) ** -0.2
    for r in density(frame(spark, values), "score", points=25).collect():
        want = sum(math.exp(-0.5 * ((r["at"] - v) / h) ** 2) for v in values)
        assert r.density == pytest.approx(want / (len(values) * h * math.sqrt(2 * math.pi)))
