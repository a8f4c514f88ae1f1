"""Clusters and classifier metrics against MLlib and plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from epigauge.operators import classify, clusters


@pytest.fixture
def points(spark):
    rnd = random.Random(3)
    data = []
    for i in range(240):
        label = i % 3
        data.append((i, label, [rnd.gauss(label * 4, 1.0), rnd.gauss(-label * 3, 1.5)], float(label * 10)))
    df = spark.createDataFrame(data, "id int, label int, x array<double>, burden double")
    return df.withColumn("features", array_to_vector("x")).persist()


def test_silhouette_equals_the_evaluator(points):
    ours = clusters.silhouette(points, "label", "x", 2).first()
    judge = ClusteringEvaluator(featuresCol="features", predictionCol="label")
    assert ours.points == 240
    assert ours.silhouette == pytest.approx(judge.evaluate(points), abs=1e-9)


def test_silhouette_of_a_lonely_point_is_zero(spark):
    df = spark.createDataFrame([(0, [0.0]), (0, [1.0]), (1, [5.0])], "label int, x array<double>")
    # points 0 and 1: a = 1, b = 25 and 16; the lonely point counts 0
    assert clusters.silhouette(df, "label", "x", 1).first().silhouette == pytest.approx((24 / 25 + 15 / 16) / 3)


def test_assignment_and_cost_equal_kmeans(spark, points):
    model = clusters.fit_kmeans(points, 3)
    centres = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    table = spark.createDataFrame(centres, "c int, centre array<double>")
    ours = clusters.assign_nearest(points, "x", table, "c")
    theirs = model.transform(points)
    assert ours.join(theirs, "id").where("cluster <> prediction").count() == 0
    cost = clusters.within_cluster_cost(ours).first().cost
    assert cost == pytest.approx(model.summary.trainingCost)


def test_equal_distance_goes_to_the_smaller_label(spark):
    table = spark.createDataFrame([(2, [2.0]), (1, [0.0])], "c int, centre array<double>")
    df = spark.createDataFrame([([1.0],)], "x array<double>")
    assert clusters.assign_nearest(df, "x", table, "c").first().cluster == 1


def test_sweep_costs_fall(points):
    rows = clusters.sweep_k(points, range(2, 5)).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4]
    assert rows[0].cost > rows[1].cost
    assert max(rows, key=lambda r: r.silhouette).k == 3


def test_severity_follows_burden_whatever_the_ids(points):
    for ids in ({0: 5, 1: 3, 2: 9}, {0: 1, 1: 0, 2: 2}):
        renamed = points.withColumn("cluster", F.create_map(*[F.lit(v) for kv in ids.items() for v in kv])[F.col("label")])
        got = clusters.relabel_by_burden(renamed, "cluster", ["burden"])
        assert got.where("severity <> label").count() == 0


def test_profile_is_in_cluster_order(points):
    rows = clusters.profile(points, "label", {"burden": "mean_burden"}).collect()
    assert [tuple(r) for r in rows] == [(0, 0.0), (1, 10.0), (2, 20.0)]


def test_quality_equals_the_evaluator(spark):
    rnd = random.Random(4)
    data = [(float(rnd.randrange(3)), float(rnd.choice([0, 0, 1, 2]))) for _ in range(500)] + [(3.0, 0.0)]
    df = spark.createDataFrame(data, "label double, prediction double")
    ours = classify.quality(classify.confusion(df)).first()
    for name, metric in [
        ("accuracy", "accuracy"),
        ("weighted_f1", "f1"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
    ]:
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df)), name
    assert ours.rows == 501


def test_split_does_not_depend_on_partitioning(spark, rows):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    bucket = classify.split_bucket([F.col("k")]).alias("b")
    assert rows(df.repartition(7).select("k", bucket)) == rows(df.coalesce(1).select("k", bucket))
    share = df.where(classify.split_bucket([F.col("k")]) < 80).count() / 5000
    assert 0.77 < share < 0.83
