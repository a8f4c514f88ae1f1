"""Indexing, scaling and components on literal rows."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from epigauge.operators.features import (
    assembler,
    fit_components,
    fit_minmax,
    fit_zscore,
    flip,
    index_labels,
    loadings,
    orientation,
)
from epigauge.plans.training import fit_vulnerability
from epigauge.spec import IndicatorSpec


def scaled(spark, fit, values, later=()):
    df = assembler(["x"], "v").transform(spark.createDataFrame([(float(v),) for v in values], "x double"))
    model = fit(df, "v", "out")
    more = assembler(["x"], "v").transform(spark.createDataFrame([(float(v),) for v in [*values, *later]], "x double"))
    return [r[0] for r in model.transform(more).select(vector_to_array("out")[0]).collect()]


def test_zscore(spark):
    assert scaled(spark, fit_zscore, [1, 2, 4]) == pytest.approx([-0.8729, -0.2182, 1.0911], abs=1e-4)
    assert scaled(spark, fit_zscore, [5, 5, 5]) == [0.0, 0.0, 0.0]


def test_minmax_is_not_clipped(spark):
    assert scaled(spark, fit_minmax, [1, 2, 4], [9]) == pytest.approx([1.0, 34.0, 100.0, 265.0])
    assert scaled(spark, fit_minmax, [5, 5, 5]) == [50.5, 50.5, 50.5]


def test_index_by_frequency_then_name(spark):
    df = spark.createDataFrame([("Urban",), ("Rural",), ("Hill",), ("Hill",)], "r string")
    assert index_labels(df, "r", "i").labels == ["Hill", "Rural", "Urban"]


def burdens(spark, sign=1.0):
    """Two burden metrics that move together and one that hardly moves."""
    return spark.range(40).select(
        (F.col("id") * 2.0).alias("a"),
        (F.col("id") * 3.0 + F.col("id") % 3).alias("b"),
        (F.col("id") % 2 * sign).alias("c"),
    )


SPEC = IndicatorSpec(metrics=("a", "b", "c"), burden=("a", "b", "c"), extra_features=())


def test_component_points_towards_more_burden(spark):
    df = assembler(["a", "b", "c"], "v").transform(burdens(spark))
    model = fit_components(df, "v", "p", k=2)
    signs = orientation(model)
    for sign, component in zip(signs, loadings(model)):
        assert sign * sum(component) >= 0
    turned = flip(signs, "p", "q").transform(model.transform(df))
    first = [r[0] for r in turned.select(vector_to_array("q")[0]).collect()]
    assert first == sorted(first)


def score(df, stages, invert=False):
    for stage in stages:
        df = stage.transform(df)
    values = [r[0] for r in df.select(vector_to_array("score_vector")[0]).collect()]
    return [101.0 - v for v in values] if invert else values


def test_score_rises_with_burden_and_the_legacy_inversion_agrees_for_a_negative_component(spark):
    df = burdens(spark).persist()
    stages, facts = fit_vulnerability(df, SPEC)
    ours = score(df, stages)
    assert min(ours) == pytest.approx(1.0) and max(ours) == pytest.approx(100.0)
    assert ours[0] < 10 < 90 < ours[-1]
    assert sum(facts["loadings"].values()) >= 0
    assert 0 < facts["explained_variance"] <= 1
    kept, kept_facts = fit_vulnerability(df, SPEC, keep_sign=True)
    negative = sum(kept_facts["loadings"].values()) < 0
    legacy = score(df, kept, invert=True)
    want = ours if negative else [101.0 - v for v in ours]
    assert legacy == pytest.approx(want)
    df.unpersist()
