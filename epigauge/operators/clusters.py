"""Clusters: k-means, assignment, cost, silhouette, profile, and a stable severity order.

Centres and cluster statistics are one short row per cluster. They are attached as a scalar
subquery (one array of structs), so no join and no collect is needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, functions as F

from epigauge.functions.numeric import total
from epigauge.session import at_once
from epigauge.spec import PROFILE_METRICS


def fit_kmeans(df: DataFrame, k: int = 3, seed: int = 42, vector: str = "features") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=vector, predictionCol="prediction").fit(df)


def sweep_k(df: DataFrame, ks: Iterable[int] = range(2, 8), seed: int = 42, vector: str = "features") -> DataFrame:
    """Cost and silhouette per k, the ks side by side. Persist ``df`` before: it is read many times."""
    spark = df.sparkSession

    def measure(k: int) -> tuple[int, float, float]:
        model = fit_kmeans(df, k, seed, vector)
        judged = ClusteringEvaluator(featuresCol=vector).evaluate(model.transform(df))
        return k, float(model.summary.trainingCost), float(judged)

    rows = at_once(spark, [partial(measure, k) for k in ks])
    return spark.createDataFrame(rows, "k int, cost double, silhouette double")


def _squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def centroids(df: DataFrame, label: str, values: str, size: int) -> DataFrame:
    """Mean point per label; ``values`` is an array column of ``size`` doubles."""
    return df.groupBy(label).agg(F.array(*[F.avg(F.col(values)[i]) for i in range(size)]).alias("centre"))


def assign_nearest(df: DataFrame, values: str, centres: DataFrame, label: str) -> DataFrame:
    """Add ``cluster`` and ``squared_distance`` of the nearest centre; the smaller label wins ties."""
    table = centres.agg(F.collect_list(F.struct("centre", F.col(label).alias("cluster"))).alias("t")).scalar()
    distances = F.transform(
        F.col("_centres"),
        lambda c: F.struct(
            _squared_distance(F.col(values), c["centre"]).alias("squared_distance"), c["cluster"].alias("cluster")
        ),
    )
    nearest = df.withColumn("_centres", table).withColumn("_nearest", F.array_min(distances))
    return nearest.select(*df.columns, "_nearest.cluster", "_nearest.squared_distance")


def within_cluster_cost(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("squared_distance").alias("cost"))


def silhouette(df: DataFrame, label: str, values: str, size: int) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, over all rows, in linear time.

    The mean squared distance from x to a cluster is |x|^2 + Q/n - 2 x.S/n, with the cluster's
    size n, sum vector S and sum of squared norms Q; no pair of rows is formed.
    """
    points = df.select(F.col(label).alias("own"), F.col(values).alias("x")).withColumn("q", _dot(F.col("x"), F.col("x")))
    stats = points.groupBy("own").agg(
        F.count("*").cast("double").alias("n"),
        F.sum("q").alias("q"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(size)]).alias("s"),
    )
    table = stats.agg(F.collect_list(F.struct(F.col("own").alias("c"), "n", "q", "s")).alias("t")).scalar()
    to_clusters = F.transform(
        F.col("_stats"),
        lambda t: F.struct(
            t["c"].alias("c"),
            t["n"].alias("n"),
            F.greatest(F.lit(0.0), F.col("q") + t["q"] / t["n"] - F.lit(2.0) * _dot(F.col("x"), t["s"]) / t["n"]).alias(
                "d"
            ),
        ),
    )
    near = points.withColumn("_stats", table).withColumn("_d", to_clusters)
    home = F.filter(F.col("_d"), lambda t: t["c"] == F.col("own"))[0]
    away = F.array_min(F.transform(F.filter(F.col("_d"), lambda t: t["c"] != F.col("own")), lambda t: t["d"]))
    parts = near.select(home.alias("home"), away.alias("b")).withColumn(
        "a", F.when(F.col("home.n") > 1, F.col("home.d") * F.col("home.n") / (F.col("home.n") - 1))
    )
    worst = F.greatest("a", "b")
    value = F.when(F.col("a").isNull() | (worst == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / worst)
    return parts.agg(F.count("*").alias("points"), F.avg(value).alias("silhouette"))


def profile(df: DataFrame, cluster: str, metrics: Mapping[str, str] = PROFILE_METRICS) -> DataFrame:
    """Mean of the profile metrics per cluster, in cluster order."""
    return df.groupBy(cluster).agg(*[F.avg(m).alias(name) for m, name in metrics.items()]).orderBy(cluster)


def severity_ranks(df: DataFrame, cluster: str, burden: Sequence[str]) -> DataFrame:
    """Cluster id to severity: 0 for the cluster with the lightest mean burden, then upwards."""
    means = df.groupBy(cluster).agg(F.avg(total(burden)).alias("mean_burden"))
    in_order = means.agg(F.array_sort(F.collect_list(F.struct("mean_burden", cluster))).alias("t"))
    return in_order.select(F.posexplode("t").alias("severity", "c")).select(
        F.col(f"c.{cluster}").alias(cluster), "severity", "c.mean_burden"
    )


def relabel_by_burden(df: DataFrame, cluster: str, burden: Sequence[str], output: str = "severity") -> DataFrame:
    """Replace arbitrary cluster ids by severities, so that runs with other ids agree."""
    ranks = severity_ranks(df, cluster, burden)
    ids = ranks.agg(F.transform(F.array_sort(F.collect_list(F.struct("severity", cluster))), lambda r: r[cluster]))
    return df.withColumn("_ids", ids.scalar()).withColumn(
        output, (F.array_position("_ids", F.col(cluster)) - 1).cast("int")
    ).drop("_ids")
