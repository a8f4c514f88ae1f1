"""Mergeable moments against MLlib and numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import PCA, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from epigauge.operators.moments import Moments, merged_moments, moments, read_moments, within_cost

NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((3_000, 3)) @ rng.standard_normal((3, 3)) * [1, 50, 1e-3] + [1e6, -3, 7]
    rows = [(*map(float, r), int(i % 3)) for i, r in enumerate(base)]
    return spark.createDataFrame(rows, "a double, b double, c double, kind int").repartition(7).persist()


def test_scaler_components_and_range_equal_mllib(table):
    m = read_moments(moments(table, NAMES), NAMES)
    vectors = VectorAssembler(inputCols=list(NAMES), outputCol="v").transform(table)
    scaler = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vectors)
    np.testing.assert_allclose(m.mean, scaler.mean.toArray(), rtol=1e-9)
    np.testing.assert_allclose(m.deviation, scaler.std.toArray(), rtol=1e-9)
    scaled = scaler.transform(vectors)
    pca = PCA(k=2, inputCol="z", outputCol="p").fit(scaled)
    found, share = m.components(2)
    theirs = pca.pc.toArray().T
    np.testing.assert_allclose(found, theirs * np.where(theirs.sum(1) < 0, -1, 1)[:, None], atol=1e-9)
    np.testing.assert_allclose(share, pca.explainedVariance.toArray(), atol=1e-9)
    ends = MinMaxScaler(inputCol="v", outputCol="s").fit(vectors)
    np.testing.assert_array_equal(m.low, ends.originalMin.toArray())
    np.testing.assert_array_equal(m.high, ends.originalMax.toArray())
    assert m.n == 3_000


def test_a_row_lands_where_the_fitted_stages_put_it(table):
    m = read_moments(moments(table, NAMES), NAMES)
    vectors = VectorAssembler(inputCols=list(NAMES), outputCol="v").transform(table)
    scaled = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vectors).transform(vectors)
    pca = PCA(k=1, inputCol="z", outputCol="p").fit(scaled)
    sign = 1.0 if pca.pc.toArray().sum() >= 0 else -1.0
    both = pca.transform(scaled).select("p", m.component(m.components(1)[0][0]).alias("mine")).collect()
    np.testing.assert_allclose([r["mine"] for r in both], [sign * r["p"][0] for r in both], atol=1e-8)


def test_new_windows_are_added_without_the_old_ones(spark, tmp_path, table):
    old, new = table.where("kind < 2"), table.where("kind = 2")
    moments(old, NAMES).write.parquet(f"{tmp_path}/kept")
    both = spark.read.parquet(f"{tmp_path}/kept").unionByName(moments(new, NAMES))
    one, whole = (read_moments(t, NAMES) for t in (merged_moments(both, NAMES), moments(table, NAMES)))
    assert one.n == whole.n
    np.testing.assert_allclose(one.mean, whole.mean, rtol=1e-12)
    np.testing.assert_allclose(one.cross, whole.cross, rtol=1e-9, atol=1e-12)


def test_one_scan(table):
    plan = moments(table.select(*NAMES), NAMES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan ") == 1 or plan.count("InMemoryTableScan") <= 2
    assert "Join" not in plan


def test_cost_by_group(table):
    want = 0.0
    rows = np.array([tuple(r) for r in table.select(*NAMES, "kind").collect()])
    for kind in range(3):
        part = rows[rows[:, 3] == kind][:, :3]
        want += ((part - part.mean(0)) ** 2).sum()
    got = within_cost(moments(table, NAMES, by=["kind"]), 3).first()
    assert got["rows"] == 3_000 and abs(got["cost"] - want) < 1e-9 * want


def test_odd_rows(spark):
    rows = [(1.0, 2.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0), (3.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    m = read_moments(moments(df, ("a", "b")), ("a", "b"))
    assert m.n == 2 and m.mean.tolist() == [2.0, 2.0] and m.deviation.tolist() == [2**0.5, 0.0]
    assert m.correlation.round(9).tolist() == [[1.0, 0.0], [0.0, 0.0]]
    assert [r[0] for r in df.limit(1).select(m.scaled("b")).collect()] == [0.0]
    assert read_moments(moments(df.limit(0), ("a", "b")), ("a", "b")) is None
    assert moments(df.where("a is null"), ("a", "b")).count() == 0
    one = Moments.of(("a",), np.array([[4.0]]))
    assert one.deviation.tolist() == [0.0] and one.merged(Moments.of(("a",), np.zeros((0, 1)))).n == 1
    with pytest.raises(ValueError, match="different columns"):
        one.merged(Moments.of(("b",), np.zeros((1, 1))))


def test_whole_numbers_and_null_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (5, "x")], "a int, kind string")
    got = {r["kind"]: (r["n"], r["mean"]) for r in moments(df, ("a",), by=["kind"]).collect()}
    assert got == {None: (2, [1.5]), "x": (1, [5.0])}
    assert moments(df.select(F.col("a").cast("long").alias("a")), ("a",)).first()["n"] == 3
