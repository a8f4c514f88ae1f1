"""Training and scoring by their invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from epigauge.plans.scoring import score_windows
from epigauge.plans.training import Bundle, feature_importance, stable_layout, train, train_on_history
from epigauge.spec import IndicatorSpec

SPEC = IndicatorSpec(metrics=("births", "cases", "deaths"), burden=("cases", "deaths"))


@pytest.fixture(scope="module")
def windows(spark):
    """Three groups of locations with light, middling and heavy burden."""
    level = F.col("id") % 3
    noise = F.pmod(F.hash("id"), F.lit(100)) / 100.0
    return spark.range(600).select(
        F.lit(dt.datetime(2024, 1, 1)).alias("window_start"),
        F.lit(dt.datetime(2024, 1, 31)).alias("window_end"),
        F.format_string("S%03d", F.col("id")).alias("State"),
        (F.col("id") % 2).cast("double").alias("Region_Index"),
        (1000.0 - 300 * level + 40 * noise).alias("births"),
        (50.0 + 200 * level + 30 * noise).alias("cases"),
        (5.0 + 20 * level + 3 * noise).alias("deaths"),
        level.cast("int").alias("truth"),
        F.lit(30).cast("long").alias("days_seen"),
    )


@pytest.fixture(scope="module")
def bundle(windows):
    return train(windows, SPEC, trees=10)


def test_severity_is_ordered_by_burden(windows, bundle):
    scored = score_windows(windows, bundle, SPEC)
    assert scored.count() == 600
    assert scored.where("Severity_Level <> truth").count() == 0
    assert bundle.facts["held_out"]["accuracy"] == 1.0
    assert sorted(bundle.facts["severity_of_cluster"].values()) == [0, 1, 2]


def test_score_rises_with_burden_within_its_range(windows, bundle):
    rows = score_windows(windows, bundle, SPEC).groupBy("truth").agg(
        F.min("Vulnerability_Score").alias("low"), F.max("Vulnerability_Score").alias("high")
    )
    low0, low1, low2 = (r for r in rows.orderBy("truth").collect())
    assert low0.low == pytest.approx(1.0) and low2.high == pytest.approx(100.0)
    assert low0.high < low1.low and low1.high < low2.low


def test_outside_the_fit_the_score_is_kept_and_clipped_beside(windows, bundle):
    heavy = windows.limit(1).withColumns({"cases": F.lit(5000.0), "deaths": F.lit(500.0)})
    row = score_windows(heavy, bundle, SPEC).first()
    assert row.Vulnerability_Score > 100 and row.Vulnerability_Clipped == 100.0


def test_rows_with_holes_are_skipped_and_unknown_regions_have_no_location(spark, windows, bundle):
    odd = windows.limit(3).withColumn("births", F.when(F.col("State") == "S000", F.lit(float("nan"))))
    assert score_windows(odd, bundle, SPEC).count() == 0
    unknown = windows.limit(1).withColumn("Region_Index", F.lit(2.0))
    row = score_windows(unknown, bundle, SPEC).first()
    assert (row.Region, row.Location) == (None, None)


def test_training_refuses_holes(windows):
    with pytest.raises(Exception):
        train(windows.withColumn("cases", F.when(F.col("State") != "S001", F.col("cases"))), SPEC, trees=2)


def test_saved_bundle_scores_the_same(spark, windows, bundle, tmp_path, rows):
    path = str(tmp_path / "bundle")
    bundle.save(spark, path)
    bundle.save(spark, path)
    loaded = Bundle.load(spark, path)
    assert loaded.facts == bundle.facts
    assert loaded.kmeans.clusterCenters()[0] == pytest.approx(bundle.kmeans.clusterCenters()[0])
    columns = ["State", "Severity_Level", "Vulnerability_Score", "Location"]
    assert rows(score_windows(windows, loaded, SPEC), *columns) == rows(score_windows(windows, bundle, SPEC), *columns)


def test_importances_sum_to_one(spark, bundle):
    got = feature_importance(bundle, spark).collect()
    assert sum(r.importance for r in got) == pytest.approx(1.0)
    assert {r.feature for r in got} == set(SPEC.features)
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)


def test_training_is_repeatable_under_another_partitioning(windows, bundle, rows):
    again = train(windows.repartition(13), SPEC, trees=10)
    columns = ["State", "Severity_Level"]
    assert rows(score_windows(windows, again, SPEC), *columns) == rows(score_windows(windows, bundle, SPEC), *columns)
    assert again.facts["cost"] == pytest.approx(bundle.facts["cost"])
    assert again.forest.featureImportances.toArray() == pytest.approx(bundle.forest.featureImportances.toArray())


def test_history_is_cleaned_and_its_region_names_are_kept(spark, windows):
    region = F.when(F.col("Region_Index") == 1, "Urban").when(F.col("State") < "S400", "Rural").otherwise("Urban")
    months = windows.drop("Region_Index", "window_start", "window_end", "truth", "days_seen")
    history = windows.select("State", region.alias("Region_Type"), *SPEC.metrics)
    empty = months.select("State", F.lit("Rural").alias("Region_Type"), *[F.lit(0.0).alias(m) for m in SPEC.metrics])
    copies = history.where("Region_Type = 'Urban'").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("n")
    bundle = train_on_history(history.union(empty).union(copies), SPEC, trees=5)
    assert bundle.region_labels == {0.0: "Urban", 1.0: "Rural"}
    assert bundle.facts["held_out"]["rows"] > 100
    assert score_windows(windows.limit(1), bundle, SPEC).first().Region == "Urban"


@pytest.mark.parametrize("files", [2, 5, 13])
def test_training_from_history_does_not_depend_on_the_files(spark, windows, monkeypatch, files):
    monkeypatch.setattr("epigauge.plans.training.ROWS_PER_TASK", 100)
    region = F.when(F.col("Region_Index") == 1, "Urban").otherwise("Rural")
    history = windows.select("State", region.alias("Region_Type"), F.lit(2024).alias("Year"), *SPEC.metrics)
    copies = history.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("n")
    every = history.union(copies)
    one, other = (train_on_history(every.repartition(n), SPEC, trees=5) for n in (1, files))
    assert one.facts["cost"] == pytest.approx(other.facts["cost"], rel=1e-12)
    assert one.facts["held_out"] == other.facts["held_out"]
    assert one.forest.featureImportances.toArray() == pytest.approx(other.forest.featureImportances.toArray())
    assert len(other.facts["features"]) == len(SPEC.features)


def test_layout_depends_on_the_row_count_only(windows):
    assert stable_layout(windows, SPEC).rdd.getNumPartitions() == 1


def test_legacy_scores_are_inverted(windows, bundle):
    legacy = train(windows, SPEC, trees=2, legacy_invert=True)
    pairs = score_windows(windows, legacy, SPEC).select("State", F.col("Vulnerability_Score").alias("legacy"))
    both = pairs.join(score_windows(windows, bundle, SPEC), "State")
    rising = sum(legacy.facts["loadings"].values()) < 0
    ours = F.col("Vulnerability_Score") if rising else 101.0 - F.col("Vulnerability_Score")
    assert both.where(F.abs(F.col("legacy") - ours) > 1e-6).count() == 0
