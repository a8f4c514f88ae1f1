"""Every operator as a query over the driver's tables; the expected results are in ``sql.py``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from epigauge.checks import fixtures
from epigauge.checks.fixtures import EVENTS
from epigauge.functions.labels import location_of, region_of, severity_of
from epigauge.functions.numeric import all_present, finite_or_null
from epigauge.operators import classify, cleaning, clusters, distribution, features
from epigauge.operators.latest import latest_rows
from epigauge.operators.moments import merged_moments, moments, read_moments, within_cost
from epigauge.operators.sketches import RANK_ERROR, keys_in, quantiles
from epigauge.operators.windows import to_full_window, watermarked, window_sums, with_finality
from epigauge.plans import scoring, serving, training
from epigauge.session import materialise, run_dir
from epigauge.sources import dated, records, replay, streams, tables
from epigauge.spec import BURDEN_METRICS, HEALTH, HEALTH_LABELS, METRICS, PROFILE_METRICS, IndicatorSpec
from epigauge.streaming import keeper
from epigauge.streaming.jobs import StreamOptions, finish, start_log, start_surveillance
from epigauge.streaming.log import VERSION, PredictionLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FEATURES = HEALTH.features
SCALED = [f"z_{i}" for i in range(len(FEATURES))]


def query(build: Query) -> Query:
    """Register ``build`` under its name; dates are read and windows laid out in UTC."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def _rounded(name: str, digits: int = 6):
    return (F.round(name, digits) + F.lit(0.0)).alias(name)


# --- sources and sinks -------------------------------------------------------------------------


@query
def daily_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fixtures.daily_reports(spark, sf_dir)
    return daily.select("day", "Date", "State", "Region_Type", "Region_Index", *METRICS)


@query
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "csv")
    schema = HEALTH.record_schema()
    tables.write_csv(fixtures.daily_reports(spark, sf_dir).select(*schema.fieldNames()), path)
    return tables.read_csv(spark, path, schema, needs=METRICS)


@query
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through JSON and back."""
    messages = records.encode(fixtures.daily_reports(spark, sf_dir), HEALTH)
    decoded = records.accepted(records.decode(messages, HEALTH))
    return decoded.select(F.to_date(HEALTH.time).alias("day"), "State", "Region_Index", *METRICS)


@query
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = fixtures.events(spark, sf_dir).withColumn("data", F.from_json("props", "k BIGINT"))
    return parsed.select("event_id", "event_type", "data.*")


def _damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON records, five in twenty unusable and three in twenty with a bad number."""
    case = F.col("event_id") % 20
    day = (
        F.when(case == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(case == 5, F.lit("01-01-9999"))
        .when(case == 6, F.lit("31-12-1899"))
        .otherwise(F.date_format("ts", EVENTS.time_format))
    )
    kind = F.when(case == 2, F.lit("")).otherwise(F.format_string(', "event_type": "%s"', "event_type"))
    number = (
        F.when(case == 3, F.lit("NaN"))
        .when(case == 4, F.lit('"abc"'))
        .when(case == 7, F.lit("Infinity"))
        .otherwise(F.col("value").cast("string"))
    )
    end = F.when(case == 0, F.lit("")).otherwise(F.lit("}"))
    text = F.concat(F.lit('{"Date": "'), day, F.lit('"'), kind, F.lit(', "value": '), number, end)
    return fixtures.events(spark, sf_dir).select(text.alias("value"))


@query
def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records.decode(_damaged_events(spark, sf_dir), EVENTS)
    usable = F.col("reject_reason").isNull()
    return decoded.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("records"),
        F.count_if(usable & F.col("value").isNotNull()).alias("values_read"),
    )


@query
def json_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that the feed's schema does not know, read back by path; of unusable records, too."""
    text = F.to_json(
        F.struct(
            F.when(F.col("event_id") % 10 != 3, F.date_format("ts", EVENTS.time_format)).alias("Date"),
            "event_type",
            "value",
            F.from_json("props", "k BIGINT").alias("props"),
            F.array(F.col("user_id"), F.col("event_id")).alias("ids"),
        )
    )
    raw = fixtures.events(spark, sf_dir).select(text.alias("value"))
    decoded = records.decode(raw, EVENTS, fields="fields")
    shown = [
        records.field("fields", "$.ids[1]", "bigint").alias("event_id"),
        records.field("fields", "$.props.k", "bigint").alias("k"),
        records.field("fields", "$.props.k", "string").alias("k_text"),
        records.field("fields", "$.ids[0]", "int").alias("user_id"),
        records.field("fields", "$.nothing", "int").alias("nothing"),
    ]
    good = records.accepted(decoded).select(*shown, F.lit("accepted").alias("outcome"))
    return good.unionByName(records.rejected(decoded).select(*shown, F.col("reject_reason").alias("outcome")))


@query
def replay_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged table through the streaming source of its own: one date a micro-batch (here a year's first day)."""
    base = run_dir(spark, "dated")
    daily = fixtures.daily_reports(spark, sf_dir).withColumn("year", F.trunc("day", "year"))
    dated.stage(records.encode(daily, HEALTH, keep=("year",)), "year", f"{base}/table")

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(F.year(F.expr("arrived - INTERVAL 1 DAY")).alias("year")).agg(F.count("*").alias("records"))
        counted.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{base}/out/{batch_id}")

    stream = dated.dated_records(spark, f"{base}/table").writeStream.foreachBatch(write)
    running = StreamOptions(f"{base}/checkpoint", every="0 seconds").start(spark, stream)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema("year int, records long, batch long").option("recursiveFileLookup", True).parquet(f"{base}/out")


@query
def replay_daily_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.records_per_date(fixtures.daily_reports(spark, sf_dir), "Date")


def _replay_ticks(spark: SparkSession, sf_dir: str, path: str, years: int, copies: int = 1):
    """Daily reports as JSON files, ``years`` years per tick, each report sent ``copies`` times."""
    daily = fixtures.daily_reports(spark, sf_dir)
    if copies > 1:
        daily = daily.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    messages = records.encode(daily, HEALTH, keep=("day",))
    return replay.replay(messages, F.floor(F.year("day") / F.lit(years)).cast("int"), path)


@query
def replay_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "ticks")
    for _ in _replay_ticks(spark, sf_dir, path, years=1):
        pass
    decoded = records.decode(spark.read.text(path), HEALTH)
    return decoded.groupBy(F.year(HEALTH.time).alias("tick")).agg(F.count("*").alias("records"))


@query
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = fixtures.daily_reports(spark, sf_dir).select("day", "State", "Region_Index", *METRICS)
    return tables.preview(daily, ["day", "State", "Region_Index"])


# --- scalar functions, filters, cleaning -------------------------------------------------------


@query
def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = F.when(F.col("event_id") % 10 == 0, F.date_format("ts", "yyyy-MM-dd"))
    text = F.coalesce(pattern, F.date_format("ts", HEALTH.time_format))
    time = records.event_time(text, HEALTH.time_format)
    return fixtures.events(spark, sf_dir).select(
        "event_id", F.to_date(time).alias("day"), time.isNotNull().alias("parsed")
    )


@query
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("event_id")
    return fixtures.events(spark, sf_dir).select(
        "event_id",
        region_of((code % 4).cast("double")).alias("Region"),
        severity_of(code % 5).alias("Severity"),
    )


@query
def location_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = region_of((F.col("event_id") % 4).cast("double"))
    return fixtures.events(spark, sf_dir).select(
        "event_id", location_of(F.col("event_type"), region).alias("Location")
    )


@query
def numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = fixtures.returned_reports(spark, sf_dir)
    return cleaning.column_report(returned, cleaning.numeric_columns(returned, exclude=HEALTH.key_names))


@query
def clean_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = fixtures.returned_reports(spark, sf_dir)
    kept = cleaning.keep_nonzero(returned, cleaning.numeric_columns(returned, exclude=HEALTH.key_names))
    return kept.select("day", "State", "Region_Index", *METRICS)


@query
def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = fixtures.returned_reports(spark, sf_dir)
    return cleaning.cleaning_report(returned, cleaning.numeric_columns(returned, exclude=HEALTH.key_names))


@query
def skip_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.keep_complete(fixtures.holed_reports(spark, sf_dir), FEATURES)
    return kept.select("day", "State", "Region_Index", *METRICS)


@query
def skip_invalid_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.completeness_report(fixtures.holed_reports(spark, sf_dir), FEATURES)


# --- windows -----------------------------------------------------------------------------------


def _window_days(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "window_start": F.to_date("window_start"),
            "window_end": F.to_date("window_end"),
            "last_day": F.to_date("last_report"),
        }
    )


WINDOW_COLUMNS = ["window_start", "window_end", "State", "Region_Index", *METRICS, "days_seen", "last_day"]


@query
def window_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = window_sums(fixtures.report_lines(spark, sf_dir), HEALTH)
    return _window_days(sums).select(*WINDOW_COLUMNS)


@query
def window_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = fixtures.holed_reports(spark, sf_dir).withColumns({m: finite_or_null(m) for m in METRICS})
    sums = window_sums(holed.withColumn(HEALTH.time, F.col("day").cast("timestamp")), HEALTH, missing_counts=True)
    shown = ["C_Section", "Child_TB", "C_Section_missing", "Child_TB_missing", "days_seen"]
    return sums.select(F.to_date("window_start").alias("window_start"), "State", "Region_Index", *shown)


@query
def window_finality(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = to_full_window(with_finality(fixtures.windows(spark, sf_dir), HEALTH), HEALTH)
    return _window_days(marked).select(
        "window_start", "State", "Region_Index", "days_seen", "is_final", _rounded("ANC_Registered")
    )


# --- aggregations and serving ------------------------------------------------------------------


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_predictions(fixtures.predictions(spark, sf_dir))


@query
def latest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir).select(
        "State",
        "Region_Index",
        "Month_Ending",
        "Severity_Level",
        _rounded("Vulnerability_Score"),
        "Region",
        "Location",
    )


@query
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = fixtures.predictions(spark, sf_dir).withColumnRenamed("Severity_Level", "prediction")
    means = clusters.profile(labelled, "prediction")
    return means.select("prediction", *[_rounded(n) for n in PROFILE_METRICS.values()])


@query
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.kpi_summary(_latest(spark, sf_dir))


@query
def high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    risky = serving.high_risk(_latest(spark, sf_dir))
    return risky.select("Location", "Month_Ending", _rounded("Vulnerability_Score"))


@query
def high_risk_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.alert(_latest(spark, sf_dir))


@query
def prediction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.feed(_latest(spark, sf_dir)).select("Location", "Severity", _rounded("Vulnerability_Score"))


@query
def severity_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.display(_latest(spark, sf_dir)).select("Location", "Severity", "display_class")


@query
def severity_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.severity_distribution(_latest(spark, sf_dir))


@query
def vulnerability_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = serving.vulnerability_ranking(_latest(spark, sf_dir))
    return ranked.select("Location", _rounded("Vulnerability_Score"), "rank")


@query
def top10_vulnerable(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = serving.top_vulnerable(_latest(spark, sf_dir))
    return top.select("Location", "Severity", _rounded("Vulnerability_Score"))


@query
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = distribution.histogram(fixtures.predictions(spark, sf_dir), "Vulnerability_Score")
    return bins.select("bin", _rounded("lower_bound"), _rounded("upper_bound"), "n")


@query
def score_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = distribution.density(fixtures.predictions(spark, sf_dir), "Vulnerability_Score")
    return curve.select("point", _rounded("at"), _rounded("density", 8))


# --- features and models -----------------------------------------------------------------------


@query
def region_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = materialise(fixtures.daily_reports(spark, sf_dir).select("Region_Type"), "daily")
    indexed = features.index_labels(daily, "Region_Type", "region_code").transform(daily)
    return indexed.groupBy("Region_Type", "region_code").agg(F.count("*").alias("n"))


def _scaled(window_table: DataFrame) -> DataFrame:
    """The window table with its z-scored features as the array column ``z``."""
    return training.scaled_features(window_table)[0].withColumn("z", vector_to_array("features"))


@query
def zscore_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = features.spread_vector(_scaled(fixtures.windows(spark, sf_dir)), "features", SCALED)
    return scaled.select(
        F.to_date("window_start").alias("window_start"),
        "State",
        F.col("Region_Index").alias("region_code"),
        *[_rounded(z) for z in SCALED],
    )


@query
def minmax_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = features.assembler(["burden"], "burden_vector").transform(fixtures.predictions(spark, sf_dir))
    scaler = features.fit_minmax(graded, "burden_vector", "scaled")
    return scaler.transform(graded).select(
        F.to_date("window_start").alias("window_start"),
        "State",
        "Region_Index",
        F.round(vector_to_array("scaled")[0], 6).alias("scaled_burden"),
    )


def _vulnerability(window_table: DataFrame) -> DataFrame:
    stages, _ = training.fit_vulnerability(window_table)
    frame = window_table
    for stage in stages:
        frame = stage.transform(frame)
    return frame.withColumns(
        {
            "pc1": vector_to_array("component")[0],
            "Vulnerability_Score": vector_to_array("score_vector")[0],
        }
    )


def _moments(spark: SparkSession, sf_dir: str, columns) -> DataFrame:
    """Moments of the windows of odd years, kept as a table, and those of even years added to them."""
    window_table = fixtures.windows(spark, sf_dir)
    odd = F.year("window_start") % 2 == 1
    kept = materialise(moments(window_table.where(odd), columns), "moments")
    return merged_moments(kept.unionByName(moments(window_table.where(~odd), columns)), columns)


@query
def moments_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, mean, deviation and ends of each metric, and its correlation with the first one."""
    m = read_moments(_moments(spark, sf_dir, METRICS), METRICS)
    rows = [
        (name, m.n, *(float(v) for v in (m.mean[i], m.deviation[i], m.low[i], m.high[i], m.correlation[0, i])))
        for i, name in enumerate(METRICS)
    ]
    schema = "metric string, rows long, mean double, deviation double, least double, most double, related double"
    told = spark.createDataFrame(rows, schema)
    return told.select("metric", "rows", _rounded("mean"), _rounded("deviation"), "least", "most", _rounded("related"))


@query
def moments_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window's place on the first component, by arithmetic with the merged moments."""
    m = read_moments(_moments(spark, sf_dir, BURDEN_METRICS), BURDEN_METRICS)
    place = m.component(m.components(1)[0][0])
    return fixtures.windows(spark, sf_dir).select(
        F.to_date("window_start").alias("window_start"), "State", "Region_Index", (F.round(place, 5) + F.lit(0.0)).alias("pc1")
    )


@query
def moments_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared distances of the windows to the mean of their severity class, from moments by class."""
    by_class = moments(fixtures.predictions(spark, sf_dir), METRICS, by=["Severity_Level"])
    return within_cost(by_class, len(METRICS)).select("rows", _rounded("cost", 4))


@query
def pca_loading(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, facts = training.fit_vulnerability(fixtures.windows(spark, sf_dir))
    rows = [(metric, float(facts["loadings"][metric])) for metric in BURDEN_METRICS]
    return spark.createDataFrame(rows, "metric string, loading double").select("metric", _rounded("loading"))


@query
def pca_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _vulnerability(fixtures.windows(spark, sf_dir))
    return scored.select(
        F.to_date("window_start").alias("window_start"), "State", "Region_Index", _rounded("pc1", 5)
    )


@query
def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's place on the first two components of all features."""
    scaled, _ = training.scaled_features(fixtures.windows(spark, sf_dir))
    return features.spread_vector(_on_plane(scaled), "plane", ["PCA1", "PCA2"]).select(
        F.to_date("window_start").alias("window_start"),
        "State",
        F.col("Region_Index").alias("region_code"),
        _rounded("PCA1", 5),
        _rounded("PCA2", 5),
    )


def _on_plane(scaled: DataFrame) -> DataFrame:
    plane = features.fit_components(scaled, "features", "raw_plane", k=2)
    return features.flip(features.orientation(plane), "raw_plane", "plane").transform(plane.transform(scaled))


@query
def vulnerability_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _vulnerability(fixtures.windows(spark, sf_dir))
    return scored.select(
        F.to_date("window_start").alias("window_start"), "State", "Region_Index", _rounded("Vulnerability_Score", 5)
    )


@query
def vulnerability_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports to windows to scores to the ten locations that are most vulnerable now."""
    scored = _vulnerability(fixtures.windows(spark, sf_dir)).select(
        "State", "Region_Index", "window_end", "Vulnerability_Score"
    )
    newest = latest_rows(scored, HEALTH.key_names, ["window_end"])
    named = newest.select(
        location_of(F.col("State"), region_of(F.col("Region_Index"))).alias("Location"), "Vulnerability_Score"
    )
    top = named.orderBy(F.desc("Vulnerability_Score"), "Location").limit(10)
    return top.select("Location", _rounded("Vulnerability_Score", 5))


@query
def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = window_sums(fixtures.report_lines(spark, sf_dir), HEALTH).withColumn(
        "window_start", F.to_date("window_start")
    )
    key = [F.col("window_start").cast("string"), F.col("State"), F.col("Region_Index").cast("int").cast("string")]
    return sums.select(
        "window_start", "State", "Region_Index", (classify.split_bucket(key) < training.TRAIN_SHARE).alias("is_train")
    )


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _scaled(fixtures.predictions(spark, sf_dir))
    centres = clusters.centroids(scaled, "Severity_Level", "z", len(FEATURES))
    return clusters.assign_nearest(scaled, "z", centres, "Severity_Level")


@query
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir).select(
        F.to_date("window_start").alias("window_start"),
        "State",
        F.col("Region_Index").alias("region_code"),
        "cluster",
        _rounded("squared_distance", 5),
    )


@query
def wssse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.within_cluster_cost(_assigned(spark, sf_dir)).select(_rounded("cost", 4))


@query
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _scaled(fixtures.predictions(spark, sf_dir))
    return clusters.silhouette(scaled, "Severity_Level", "z", len(FEATURES)).select("points", _rounded("silhouette"))


@query
def severity_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    ided = fixtures.predictions(spark, sf_dir).withColumn("cluster", (F.col("Severity_Level") * 2 + 1) % 3)
    return clusters.relabel_by_burden(ided, "cluster", HEALTH.burden).select(
        F.to_date("window_start").alias("window_start"), "State", "Region_Index", "severity"
    )


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.confusion(fixtures.predictions(spark, sf_dir), "Severity_Level", "Predicted_Level")


@query
def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = classify.confusion(fixtures.predictions(spark, sf_dir), "Severity_Level", "Predicted_Level")
    rates = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1"]
    return classify.quality(matrix).select("rows", *[_rounded(r) for r in rates])


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separated windows, scaled, with the severity of their fitted cluster; laid out and scaled once."""
    table = training.stable_layout(fixtures.separated_windows(spark, sf_dir), HEALTH)
    scaled = materialise(training.scaled_features(table)[0].drop("raw_features"), "scaled")
    clustered = clusters.fit_kmeans(scaled).transform(scaled)
    return clusters.relabel_by_burden(clustered, "prediction", HEALTH.burden)


@query
def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).select(
        F.to_date("window_start").alias("window_start"), "State", "Region_Index", "severity"
    )


@query
def k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two to seven clusters side by side. The true number has an exact answer; for every number the cost and the silhouette
    are worked out again from the assignment alone."""
    table = training.stable_layout(fixtures.separated_windows(spark, sf_dir), HEALTH)
    scaled = training.scaled_features(table)[0].select("features").persist()
    again = []
    try:
        swept = {r["k"]: r for r in clusters.sweep_k(scaled).collect()}
        for k, told in swept.items():
            assigned = clusters.fit_kmeans(scaled, k).transform(scaled).withColumn("z", vector_to_array("features"))
            assigned = assigned.select("prediction", "z", *[F.col("z")[i].alias(z) for i, z in enumerate(SCALED)])
            cost = within_cost(moments(assigned, SCALED, by=["prediction"]), len(SCALED)).first()["cost"]
            judged = clusters.silhouette(assigned, "prediction", "z", len(SCALED)).first()["silhouette"]
            again.append((k, abs(cost - told["cost"]) < 1e-6 * cost, abs(judged - told["silhouette"]) < 1e-6))
    finally:
        scaled.unpersist()
    true = swept[3]
    rows = [(*row, true["cost"] if row[0] == 3 else None, true["silhouette"] if row[0] == 3 else None) for row in again]
    told = spark.createDataFrame(rows, "k int, cost_agrees boolean, silhouette_agrees boolean, cost double, silhouette double")
    return told.select("k", "cost_agrees", "silhouette_agrees", _rounded("cost", 4), _rounded("silhouette"))


@query
def cluster_map_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's place on the first two components, with the health status of its cluster."""
    return features.spread_vector(_on_plane(_clustered(spark, sf_dir)), "plane", ["PCA1", "PCA2"]).select(
        F.to_date("window_start").alias("window_start"),
        "State",
        F.col("Region_Index").alias("region_code"),
        _rounded("PCA1", 5),
        _rounded("PCA2", 5),
        "severity",
        severity_of(F.col("severity"), HEALTH_LABELS).alias("Health_Status"),
    )


def _bundle(spark: SparkSession, sf_dir: str) -> tuple[training.Bundle, DataFrame]:
    window_table = fixtures.separated_windows(spark, sf_dir)
    return training.train(window_table), window_table


@query
def severity_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle, _ = _bundle(spark, sf_dir)
    held = bundle.facts["held_out"]
    row = (bundle.forest.getNumTrees, bundle.forest.numClasses, bundle.facts["cost"], *held.values())
    rates = [name for name in held if name != "rows"]
    columns = ", ".join(f"{name} double" for name in rates)
    trained = spark.createDataFrame([row], f"trees int, classes int, cost double, rows bigint, {columns}")
    return trained.select("trees", "classes", _rounded("cost", 4), "rows", *[_rounded(r) for r in rates])


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What carries the classes: the metrics, which tell the kinds apart, and not the region, which tells nothing."""
    ordered = training.feature_importance(_bundle(spark, sf_dir)[0], spark).withColumn("place", F.monotonically_increasing_id())
    ordered = materialise(ordered, "importance")
    kind = F.when(F.col("feature").isin(*METRICS), F.lit("metric")).otherwise(F.lit("region")).alias("kind")
    by_place = F.transform(F.array_sort(F.collect_list(F.struct("place", "importance"))), lambda p: p["importance"])
    return ordered.groupBy(kind).agg(
        F.count_distinct("feature").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        (by_place == F.reverse(F.array_sort(by_place))).alias("falling"),
    )


@query
def severity_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle, window_table = _bundle(spark, sf_dir)
    scored = scoring.score_windows(window_table, bundle)
    return scored.groupBy("Severity_Level", severity_of(F.col("Severity_Level")).alias("Severity")).agg(
        F.count("*").alias("n")
    )


@query
def score_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle, window_table = _bundle(spark, sf_dir)
    return scoring.score_windows(window_table, bundle).select(
        F.to_date("window_start").alias("window_start"),
        F.to_date("Month_Ending").alias("Month_Ending"),
        "State",
        "Region_Index",
        "Severity_Level",
        _rounded("Vulnerability_Score", 5),
        _rounded("Vulnerability_Clipped", 5),
        "Region",
        "Location",
    )


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored differently by a bundle and by its saved and loaded copy."""
    bundle, window_table = _bundle(spark, sf_dir)
    path = run_dir(spark, "bundle")
    bundle.save(spark, path)
    results = ["Severity_Level", "Vulnerability_Score"]
    keys = ["window_start", *HEALTH.key_names]
    before = scoring.score_windows(window_table, bundle).select(*keys, F.struct(*results).alias("before"))
    after = scoring.score_windows(window_table, training.Bundle.load(spark, path)).select(
        *keys, F.struct(*results).alias("after")
    )
    both = before.join(after, keys, "full")
    return both.agg(
        F.count("*").alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differing")
    )


# --- streaming ---------------------------------------------------------------------------------


@query
def stream_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table read as a stream, counted by type and day."""
    path = f"{sf_dir}/events.parquet"
    stream = streams.table_stream(spark, path, spark.read.parquet(path).schema)
    counts = stream.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("records"))
    base = run_dir(spark, "stream")
    log = PredictionLog(f"{base}/log", EVENTS)
    finish([start_log(counts, log, StreamOptions(f"{base}/checkpoint"))])
    return latest_rows(log.read(spark), ["event_type", "day"], VERSION).drop(*VERSION)


@query
def stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows only, each emitted once."""
    path = f"{sf_dir}/events.parquet"
    stream = streams.table_stream(spark, path, spark.read.parquet(path).schema)
    timed = stream.withColumn(EVENTS.time, F.col("ts").cast("timestamp"))
    sums = window_sums(watermarked(timed, EVENTS), EVENTS)
    base = run_dir(spark, "stream")
    log = PredictionLog(f"{base}/log", EVENTS)
    finish([start_log(sums, log, StreamOptions(f"{base}/checkpoint"), "append")])
    return log.read(spark).select(
        F.to_date("window_start").alias("window_start"), "event_type", _rounded("value", 4), "days_seen"
    )


def _surveyed(spark: SparkSession, sf_dir: str, copies: int = 1, **options) -> PredictionLog:
    """Daily reports replayed as JSON files, two years per micro-batch, into a log."""
    base = run_dir(spark, "stream")
    log = PredictionLog(f"{base}/log")
    for _ in _replay_ticks(spark, sf_dir, f"{base}/in", years=2, copies=copies):
        source = streams.file_records(spark, f"{base}/in")
        finish(start_surveillance(source, log, f"{base}/quarantine", f"{base}/checkpoint", **options))
    return log


@query
def stream_update_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = with_finality(_surveyed(spark, sf_dir).windows(spark), HEALTH)
    return _window_days(states).select(*WINDOW_COLUMNS, "is_final")


@query
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest window per location from a log of two runs, one for each line status, compacted between them."""
    base = run_dir(spark, "stream")
    log = PredictionLog(f"{base}/log")
    ticks = {"early": 4, "late": 3}  # years per micro-batch

    def survey(run: str, region: float) -> None:
        daily = fixtures.daily_reports(spark, sf_dir).where(F.col("Region_Index") == region)
        year = F.floor(F.year("day") / F.lit(ticks[run])).cast("int")
        for _ in replay.replay(records.encode(daily, HEALTH, keep=("day",)), year, f"{base}/{run}"):
            source = streams.file_records(spark, f"{base}/{run}")
            finish(start_surveillance(source, log, f"{base}/quarantine-{run}", f"{base}/checkpoint-{run}"))
            log.compact(spark)  # the other run is older or newer, and goes on afterwards

    survey("early", 0.0)
    survey("late", 1.0)
    log.retain(spark, 0)
    return _window_days(log.latest(spark)).select(*WINDOW_COLUMNS)


@query
def stream_once_per_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report delivered three times, counted once."""
    log = _surveyed(spark, sf_dir, copies=3, once_per_report=True)
    return _window_days(log.windows(spark)).select(*WINDOW_COLUMNS)


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "stream")
    _damaged_events(spark, sf_dir).write.text(f"{base}/in")
    log = PredictionLog(f"{base}/log", EVENTS)
    source = streams.file_records(spark, f"{base}/in")
    started = start_surveillance(source, log, f"{base}/quarantine", f"{base}/checkpoint", EVENTS, once_per_report=True)
    finish(started)
    set_aside = spark.read.parquet(f"{base}/quarantine")
    return set_aside.groupBy("reject_reason").agg(F.count("*").alias("records"))


@query
def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows scored inside the stream; their last state has the score of the batch result."""
    bundle, _ = _bundle(spark, sf_dir)
    score = lambda sums: scoring.score_windows(fixtures.separated(sums), bundle)
    return _surveyed(spark, sf_dir, score=score).windows(spark).select(
        F.to_date("window_start").alias("window_start"),
        "State",
        "Region_Index",
        "Severity_Level",
        _rounded("Vulnerability_Score", 5),
    )


def _holed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily reports as JSON; one state never tells two of its metrics, others leave holes."""
    holed = fixtures.daily_reports(spark, sf_dir).withColumns(
        {
            "C_Section": F.when((F.dayofmonth("day") % 5 != 0) & (F.col("State") != "S03"), F.col("C_Section")),
            "Child_TB": F.when(F.col("State") != "S03", F.col("Child_TB")),
        }
    )
    return records.encode(holed, HEALTH, keep=("day",))


def _holed_log(spark: SparkSession, sf_dir: str) -> PredictionLog:
    """Holed reports streamed with missing counts and full windows, scored by their burden per day."""
    base = run_dir(spark, "stream")
    log = PredictionLog(f"{base}/log")

    def score(sums: DataFrame) -> DataFrame:
        return sums.where(all_present(FEATURES))

    for _ in replay.replay(_holed_messages(spark, sf_dir), F.floor(F.year("day") / F.lit(2)).cast("int"), f"{base}/in"):
        source = streams.file_records(spark, f"{base}/in")
        queries = start_surveillance(
            source, log, f"{base}/quarantine", f"{base}/checkpoint", score=score, missing_counts=True, full_windows=True
        )
        finish(queries)
    return log


@query
def stream_holed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums scaled to full windows, missing counts and finality of the windows that could be scored."""
    states = _holed_log(spark, sf_dir).windows(spark, finality=True)
    return states.select(
        F.to_date("window_start").alias("window_start"),
        "State",
        "Region_Index",
        _rounded("C_Section", 5),
        _rounded("Child_TB", 5),
        "C_Section_missing",
        "Child_TB_missing",
        "days_seen",
        "is_final",
    )


@query
def stream_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many windows of each state could not be scored."""
    return _holed_log(spark, sf_dir).skipped(spark).groupBy("State").agg(F.count("*").alias("windows"))


def _kept(spark: SparkSession, sf_dir: str, spec: IndicatorSpec, tick: Column, start: Callable) -> str:
    """Daily reports replayed tick by tick into a stream that ``start`` makes of them; gives its folder."""
    base = run_dir(spark, "stream")
    messages = records.encode(fixtures.daily_reports(spark, sf_dir), HEALTH, keep=("day", "State"))
    for _ in replay.replay(messages, tick, f"{base}/in"):
        decoded = records.decode(streams.file_records(spark, f"{base}/in"), spec)
        reports = watermarked(records.accepted(decoded), spec)
        finish([start(reports, base, StreamOptions(f"{base}/checkpoint", rocksdb=True))])
    return base


SHOWN_SUMS = ["ANC_Registered", "Child_TB", "Early_Breastfeeding"]


@query
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth day's reports of every fourth state come years late: told as late, and added to their closed windows."""
    delayed = (F.dayofyear("day") % 9 == 0) & (F.substring("State", 2, 2).cast("int") % 4 == 0)
    tick = F.floor(F.year("day") / F.lit(2)).cast("int") + F.when(delayed, F.lit(1)).otherwise(F.lit(0))

    def start(reports: DataFrame, base: str, options: StreamOptions):
        return keeper.start_kept(reports, PredictionLog(f"{base}/log"), options)

    log = PredictionLog(f"{_kept(spark, sf_dir, HEALTH, tick, start)}/log")
    log.compact(spark)
    whole = keeper.corrected(log.windows(spark), log.late(spark), HEALTH)
    late = log.late(spark).select("window_start", *HEALTH.key_names, *[F.col(m).alias(f"late_{m}") for m in SHOWN_SUMS])
    keys = ["window_start", *HEALTH.key_names]
    return whole.join(late, keys, "left").select(
        F.to_date("window_start").alias("window_start"),
        *HEALTH.key_names,
        *SHOWN_SUMS,
        *[f"late_{m}" for m in SHOWN_SUMS],
        "days_seen",
        "reports",
        "late_reports",
    )


MONTHLY = replace(HEALTH, calendar="month")


@query
def stream_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by calendar month, kept and closed inside the stream."""
    tick = F.floor(F.year("day") / F.lit(2)).cast("int")

    def start(reports: DataFrame, base: str, options: StreamOptions):
        return keeper.start_kept(reports, PredictionLog(f"{base}/log", MONTHLY), options)

    log = PredictionLog(f"{_kept(spark, sf_dir, MONTHLY, tick, start)}/log", MONTHLY)
    return _window_days(log.windows(spark)).select(*WINDOW_COLUMNS, "is_closed")


@query
def month_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by calendar month of a batch, scaled to full months."""
    sums = to_full_window(window_sums(fixtures.report_lines(spark, sf_dir), MONTHLY), MONTHLY)
    return sums.select(
        F.to_date("window_start").alias("window_start"), *HEALTH.key_names, *[_rounded(m) for m in SHOWN_SUMS], "days_seen"
    )


@query
def stream_live_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest window per location out of the stream's own state; there is no log."""
    tick = F.floor(F.year("day") / F.lit(2)).cast("int")

    def start(reports: DataFrame, base: str, options: StreamOptions):
        newest = keeper.newest_windows(keeper.kept_windows(reports, HEALTH), HEALTH)
        writer = newest.writeStream.outputMode("append").format("parquet").option("path", f"{base}/changes")
        return options.start(spark, writer)

    base = _kept(spark, sf_dir, HEALTH, tick, start)
    return _window_days(keeper.live_latest(spark, f"{base}/checkpoint", HEALTH)).select(*WINDOW_COLUMNS)


@query
def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that reports can still change, read from the state of the running aggregation."""
    base = run_dir(spark, "stream")
    for _ in _replay_ticks(spark, sf_dir, f"{base}/in", years=4):
        source = streams.file_records(spark, f"{base}/in")
        finish(start_surveillance(source, PredictionLog(f"{base}/log"), f"{base}/quarantine", f"{base}/checkpoint"))
    return _window_days(keeper.open_windows(spark, f"{base}/checkpoint/log", HEALTH)).select(*WINDOW_COLUMNS)


def _sketched(spark: SparkSession, sf_dir: str) -> PredictionLog:
    """Closed windows with a sketch per micro-batch, partly folded into a snapshot."""
    base = run_dir(spark, "stream")
    log = PredictionLog(f"{base}/log")
    for _ in _replay_ticks(spark, sf_dir, f"{base}/in", years=2):
        source = streams.file_records(spark, f"{base}/in")
        bad, checkpoint = f"{base}/quarantine", f"{base}/checkpoint"
        finish(start_surveillance(source, log, bad, checkpoint, output_mode="append", sketches=("State", "ANC_Registered")))
    log.compact(spark)
    return log


@query
def stream_sketched_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key figures of all closed windows from merged sketches; no window is read."""
    merged = _sketched(spark, sf_dir).sketches(spark)
    return merged.select(
        F.round(keys_in()).cast("long").alias("states"), "rows", F.col("least").alias("least"), F.col("most").alias("most")
    )


@query
def stream_sketched_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles from merged sketches, held against the windows: is each one's rank within the stated error?"""
    log = _sketched(spark, sf_dir)
    asked = materialise(quantiles(log.sketches(spark), [i / 20 for i in range(1, 20)]), "quantiles")
    met = log.read(spark).select("ANC_Registered").join(F.broadcast(asked))  # 19 rows
    ranks = met.groupBy("share", "score").agg(
        F.avg((F.col("ANC_Registered") < F.col("score")).cast("double")).alias("below"),
        F.avg((F.col("ANC_Registered") <= F.col("score")).cast("double")).alias("upto"),
    )
    near = (F.col("below") <= F.col("share") + RANK_ERROR) & (F.col("upto") >= F.col("share") - RANK_ERROR)
    return ranks.select(F.round(F.col("share") * 100).cast("int").alias("percent"), near.alias("within_error"))
