"""Score windowed sums with a bundle; the same plan for a batch and a stream."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from epigauge.functions.labels import location_of, region_of
from epigauge.plans.training import Bundle
from epigauge.spec import HEALTH, IndicatorSpec


def score_windows(windows: DataFrame, bundle: Bundle, spec: IndicatorSpec = HEALTH) -> DataFrame:
    """Severity, vulnerability score and location for each window and key.

    Rows with a null or NaN sum are skipped. ``Vulnerability_Score`` may leave 1..100 for sums
    outside the range of the fit; ``Vulnerability_Clipped`` does not. A bundle trained with
    ``legacy_invert`` gives 101 minus the scaled component, whose sign it left as fitted.
    """
    scored = bundle.model.transform(windows)
    scaled = vector_to_array("score_vector")[0]
    score = F.lit(101.0) - scaled if bundle.facts["legacy_invert"] else scaled
    region = region_of(F.col("Region_Index"), bundle.region_labels)
    kept = [c for c in windows.columns if c not in spec.metrics]
    return scored.select(
        *kept,
        F.col("window_end").alias("Month_Ending"),
        F.col("prediction").cast("int").alias("Severity_Level"),
        score.alias("Vulnerability_Score"),
        F.greatest(F.lit(1.0), F.least(F.lit(100.0), score)).alias("Vulnerability_Clipped"),
        region.alias("Region"),
        location_of(F.col("State"), region).alias("Location"),
    )
