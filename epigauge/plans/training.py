"""Training: clusters as severity labels, a forest that predicts them, and the vulnerability score.

Everything fitted goes into one ``Bundle``, so that scalers, forest and score never come from
different runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from epigauge.operators.classify import confusion, quality, split_bucket
from epigauge.operators.cleaning import indicator_columns, keep_nonzero
from epigauge.operators.clusters import fit_kmeans, severity_ranks
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
from epigauge.session import at_once, materialise
from epigauge.spec import HEALTH, REGION_LABELS, IndicatorSpec

ROWS_PER_TASK = 20_000
TRAIN_SHARE = 80


@dataclass
class Bundle:
    """All fitted stages as one pipeline, the k-means model behind the labels, and their facts."""

    model: PipelineModel
    kmeans: KMeansModel
    facts: dict = field(default_factory=dict)

    @property
    def forest(self) -> RandomForestClassificationModel:
        return next(s for s in self.model.stages if isinstance(s, RandomForestClassificationModel))

    @property
    def region_labels(self) -> dict[float, str]:
        return {float(code): label for code, label in self.facts["region_labels"].items()}

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.kmeans.write().overwrite().save(f"{path}/kmeans")
        facts = spark.createDataFrame([(json.dumps(self.facts),)], "value string")
        facts.write.mode("overwrite").text(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        text = spark.read.text(f"{path}/facts", wholetext=True).first().value
        return cls(PipelineModel.load(f"{path}/model"), KMeansModel.load(f"{path}/kmeans"), json.loads(text))


def row_key(df: DataFrame, spec: IndicatorSpec) -> list[str]:
    """What tells rows apart: window and key, or keys and values in a table without windows."""
    if "window_start" in df.columns:
        return ["window_start", *spec.key_names]
    return [*spec.key_names, *spec.metrics]


def stable_layout(df: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Sorted rows in a number of partitions that follows from the row count alone.

    Rows go by the hash of their key. Fits that sample per partition (k-means start, forest bags) then
    see the same rows in the same places on any cluster and for any layout of the input. A table
    without windows may hold many copies of a row: they are counted, numbered and dealt out by number.
    """
    order = row_key(df, spec)
    tasks = 1 + df.count() // ROWS_PER_TASK
    if "window_start" in order:
        return df.repartition(tasks, *order).sortWithinPartitions(*order)
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    numbered = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
    return numbered.repartition(tasks, *df.columns, "copy").sortWithinPartitions(*df.columns, "copy").drop("copy")


def scaled_features(windows: DataFrame, spec: IndicatorSpec = HEALTH) -> tuple[DataFrame, object]:
    """Add ``raw_features`` and z-scored ``features``; null or NaN in a feature is an error."""
    vectors = assembler(spec.features, "raw_features").transform(windows)
    scaler = fit_zscore(vectors, "raw_features", "features")
    return scaler.transform(vectors), scaler


def fit_vulnerability(windows: DataFrame, spec: IndicatorSpec = HEALTH, keep_sign: bool = False) -> tuple[list, dict]:
    """Stages burden vector -> z-score -> first component -> sign -> 1..100, and their facts.

    With ``keep_sign`` the component keeps the sign the fit gave it (see ``legacy_invert``).
    """
    stages = [assembler(spec.burden, "burden_vector", "skip")]
    frame = assembler(spec.burden, "burden_vector").transform(windows)
    stages.append(fit_zscore(frame, "burden_vector", "scaled_burden"))
    frame = stages[-1].transform(frame)
    component = fit_components(frame, "scaled_burden", "raw_component", k=1)
    stages.append(component)
    signs = [1.0] if keep_sign else orientation(component)
    stages.append(flip(signs, "raw_component", "component"))
    frame = stages[-1].transform(component.transform(frame))
    stages.append(fit_minmax(frame, "component", "score_vector"))
    facts = {
        "loadings": dict(zip(spec.burden, [signs[0] * x for x in loadings(component)[0]])),
        "explained_variance": float(component.explainedVariance[0]),
    }
    return stages, facts


def train(
    windows: DataFrame,
    spec: IndicatorSpec = HEALTH,
    k: int = 3,
    seed: int = 42,
    trees: int = 50,
    depth: int = 5,
    region_labels: Mapping[float, str] = REGION_LABELS,
    legacy_invert: bool = False,
) -> Bundle:
    """Fit the bundle on one row per window (or month) and location.

    The input is written once as a table, since the fits pass over it many times.
    """
    table = materialise(windows, "training")
    severity, vulnerability = at_once(
        table.sparkSession,
        [
            lambda: _fit_severity(table, spec, k, seed, trees, depth),
            lambda: fit_vulnerability(table, spec, keep_sign=legacy_invert),
        ],
    )
    stages, kmeans, facts = severity
    facts |= vulnerability[1]
    facts |= {
        "fit_id": uuid.uuid4().hex,
        "region_labels": {str(code): label for code, label in region_labels.items()},
        "features": spec.features,
        "burden": list(spec.burden),
        "legacy_invert": legacy_invert,
    }
    return Bundle(PipelineModel([*stages, *vulnerability[0]]), kmeans, facts)


def train_on_history(
    history: DataFrame, spec: IndicatorSpec = HEALTH, region: str = "Region_Type", **options
) -> Bundle:
    """Train on a raw monthly table: rows without any indicator are dropped and the region names are indexed.

    The bundle keeps the names, so that scoring shows the region a code was given in training.
    """
    cleaned = keep_nonzero(history, indicator_columns(history, spec))
    indexer = index_labels(cleaned, region, "Region_Index")
    labels = {float(code): name for code, name in enumerate(indexer.labels)}
    needed = [*spec.key_names, *spec.metrics, *spec.extra_features]
    return train(indexer.transform(cleaned).select(*dict.fromkeys(needed)), spec, region_labels=labels, **options)


def _fit_severity(
    table: DataFrame, spec: IndicatorSpec, k: int, seed: int, trees: int, depth: int
) -> tuple[list, KMeansModel, dict]:
    """Clusters ordered by burden as labels, and a forest that predicts them from the features."""
    features, scaler = scaled_features(stable_layout(table, spec), spec)
    needed = dict.fromkeys([*row_key(table, spec), *spec.burden, "features"])
    features = features.select(*needed).persist()
    try:
        kmeans = fit_kmeans(features, k, seed)
        clustered = kmeans.transform(features)
        ranks = {r.prediction: r.severity for r in severity_ranks(clustered, "prediction", spec.burden).collect()}
        labels = F.array(*[F.lit(float(ranks.get(c, 0))) for c in range(k)])
        order = [F.col(c).cast("string") for c in row_key(table, spec)]
        labelled = (
            clustered.withColumn("label", labels[F.col("prediction")])
            .drop("prediction")
            .withColumn("is_train", split_bucket(order) < TRAIN_SHARE)
        )
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed
        ).fit(labelled.where("is_train"))
        held_out = quality(confusion(forest.transform(labelled.where("NOT is_train")))).first()
    finally:
        features.unpersist()
    facts = {
        "severity_of_cluster": {str(c): int(s) for c, s in ranks.items()},
        "cost": float(kmeans.summary.trainingCost),
        "held_out": held_out.asDict(),
    }
    return [assembler(spec.features, "raw_features", "skip"), scaler, forest], kmeans, facts


def feature_importance(bundle: Bundle, spark: SparkSession) -> DataFrame:
    """What drives the severity classes, most important first."""
    weights = bundle.forest.featureImportances.toArray().tolist()
    schema = T.StructType().add("feature", "string").add("importance", "double")
    rows = list(zip(bundle.facts["features"], weights))
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature")
