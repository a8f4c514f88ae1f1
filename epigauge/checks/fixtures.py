"""Indicator tables derived from the driver's tables; ``sql.py`` has the same definitions in SQL.

``lineitem`` stands in for the reports: a supplier's number gives the state, the line status the
region, the part number the indicator, the quantity its value, the ship date the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from epigauge.functions.labels import location_of, region_of
from epigauge.functions.numeric import total
from epigauge.operators.windows import window_sums
from epigauge.session import materialise
from epigauge.spec import HEALTH, METRICS, IndicatorSpec

STATES = 36

# Events as an indicator feed of their own: one metric by event type.
EVENTS = IndicatorSpec(
    keys=(("event_type", "string"),),
    metrics=("value",),
    burden=(),
    extra_features=(),
    window_days=30,
)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``timestamp`` (a watermark needs a zoned timestamp; the session runs in UTC)."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(HEALTH.time, F.col("ts").cast("timestamp"))


def _keys() -> list[Column]:
    state = F.concat(F.lit("S"), F.lpad((F.col("l_suppkey") % STATES).cast("string"), 2, "0"))
    rural = F.col("l_linestatus") == "F"
    return [
        F.to_date("l_shipdate").alias("day"),
        state.alias("State"),
        F.when(rural, F.lit("Rural")).otherwise(F.lit("Urban")).alias("Region_Type"),
        F.when(rural, F.lit(0.0)).otherwise(F.lit(1.0)).alias("Region_Index"),
    ]


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per line: its quantity under one of the metrics, 0 under the others."""
    slot = F.col("l_partkey") % len(METRICS)
    return lineitem(spark, sf_dir).select(
        F.col("l_shipdate").cast("timestamp").alias(HEALTH.time),
        *_keys(),
        *[F.when(slot == i, F.col("l_quantity")).otherwise(F.lit(0.0)).alias(m) for i, m in enumerate(METRICS)],
    )


def daily_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day, state and region, with the day as text as a record carries it."""
    daily = (
        report_lines(spark, sf_dir)
        .groupBy("day", "State", "Region_Type", "Region_Index")
        .agg(*[F.sum(m).alias(m) for m in METRICS])
    )
    return daily.withColumn(HEALTH.time_text, F.date_format("day", HEALTH.time_format))


def holed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily reports with a null every fifth and a NaN every seventh day of the month."""
    day = F.dayofmonth("day")
    return daily_reports(spark, sf_dir).withColumns(
        {
            "C_Section": F.when(day % 5 != 0, F.col("C_Section")),
            "Child_TB": F.when(day % 7 == 0, F.lit(float("nan"))).otherwise(F.col("Child_TB")),
        }
    )


def returned_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums of returned lines only: many rows are all zero; every second metric is null, not 0."""
    slot = F.col("l_partkey") % len(METRICS)
    returned = F.col("l_returnflag") == "R"
    sums = []
    for i, m in enumerate(METRICS):
        hit = F.when(returned & (slot == i), F.col("l_quantity"))
        sums.append(F.sum(hit if i % 2 else F.coalesce(hit, F.lit(0.0))).alias(m))
    keyed = lineitem(spark, sf_dir).select(*_keys(), "l_partkey", "l_returnflag", "l_quantity")
    return keyed.groupBy("day", "State", "Region_Type", "Region_Index").agg(*sums)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-day sums of all report lines, written once: every later pass reads this small table."""
    return materialise(window_sums(report_lines(spark, sf_dir), HEALTH), "windows")


def separated(window_table: DataFrame) -> DataFrame:
    """The windows with metrics that keep three kinds of states far apart, so that fitted models have one answer.

    A state's number gives its kind (``truth``, 0 the lightest); what is left of the sums is a little noise.
    """
    truth = F.substring("State", 2, 2).cast("int") % 3
    far = {m: (truth + 1) * F.lit(1000.0 * (1 + i % 3)) + F.col(m) % 5 for i, m in enumerate(METRICS)}
    kept = [c for c in window_table.columns if c not in METRICS]
    # Through inline, so that what follows does not work the expressions out again for every use.
    made = F.struct(*[value.alias(m) for m, value in far.items()], truth.alias("truth"))
    return window_table.select(*kept, F.inline(F.array(made)))


def separated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(separated(windows(spark, sf_dir)), "separated")


def with_rule_predictions(window_table: DataFrame) -> DataFrame:
    """Severity and score by rule, so that what follows has an exact answer without a fitted model.

    The score is the burden on 1..100; the severity compares the burden per reported day with its
    mean, so that a partly reported window is graded fairly. About one row in seven has a wrong
    ``Predicted_Level``, for the classifier metrics.
    """
    burden = window_table.withColumn("burden", total(HEALTH.burden))
    spread = burden.agg(
        F.struct(
            F.min("burden").alias("low"),
            F.max("burden").alias("high"),
            (F.sum("burden") / F.sum("days_seen")).alias("daily"),
        )
    ).scalar()
    region = region_of(F.col("Region_Index"))
    scored = burden.withColumn("s", spread).withColumns(
        {
            "Vulnerability_Score": F.lit(1.0)
            + F.lit(99.0) * (F.col("burden") - F.col("s.low")) / (F.col("s.high") - F.col("s.low")),
            "Severity_Level": F.when(F.col("burden") > F.col("s.daily") * 1.05 * F.col("days_seen"), F.lit(2))
            .when(F.col("burden") < F.col("s.daily") * 0.95 * F.col("days_seen"), F.lit(0))
            .otherwise(F.lit(1)),
        }
    )
    wrong = F.col("burden").cast("long") % 7 == 0
    return scored.drop("s").withColumns(
        {
            "Month_Ending": F.to_date("window_end"),
            "Predicted_Level": F.when(wrong, (F.col("Severity_Level") + 1) % 3).otherwise(F.col("Severity_Level")),
            "Region": region,
            "Location": location_of(F.col("State"), region),
        }
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rule_predictions(windows(spark, sf_dir))
