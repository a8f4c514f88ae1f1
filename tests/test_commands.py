"""The whole way by command: clean, train, send, stream, compact, serve."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from epigauge import __main__ as commands
from epigauge.sources.tables import write_csv
from epigauge.spec import HEALTH, METRICS
from epigauge.streaming.log import PredictionLog


def history(spark):
    """Monthly rows of six states; the later the letter, the heavier the burden."""
    rnd = random.Random(6)
    data = []
    for month in range(1, 25):
        for weight, state in enumerate("ABCDEF"):
            for region in ("Rural", "Urban"):
                values = [float(30 * rnd.randrange(1 + 10 * weight, 10 + 10 * weight)) for _ in METRICS]
                data.append((f"2022-{month:02d}", state, region, *values))
        data.append((f"2022-{month:02d}", "Z", "Rural", *[0.0] * len(METRICS)))
    columns = ["Month", "State", "Region_Type", *METRICS]
    return spark.createDataFrame(data, columns)


def daily(spark):
    start = dt.date(2024, 1, 1)
    rnd = random.Random(7)
    data = []
    for i in range(50):
        for weight, state in enumerate("ABCDEF"):
            values = [float(rnd.randrange(1 + 10 * weight, 10 + 10 * weight)) for _ in METRICS]
            data.append(((start + dt.timedelta(days=i)).strftime("%d-%m-%Y"), state, 0.0, *values))
    return spark.createDataFrame(data, HEALTH.record_schema())


def test_from_raw_history_to_dashboard(spark, tmp_path):
    base = str(tmp_path)
    write_csv(history(spark), f"{base}/raw.csv")
    write_csv(daily(spark), f"{base}/daily.csv")
    commands.main(["clean", "--input", f"{base}/raw.csv", "--output", f"{base}/clean.csv"])
    commands.main(["train", "--input", f"{base}/clean.csv", "--bundle", f"{base}/bundle"])
    commands.main(["send", "--input", f"{base}/daily.csv", "--folder", f"{base}/in"])
    run = ["stream", "--folder", f"{base}/in", "--bundle", f"{base}/bundle", "--log", f"{base}/log"]
    run += ["--quarantine", f"{base}/q", "--checkpoint", f"{base}/c", "--files-per-batch", "25"]
    commands.main(run)
    commands.main(["compact", "--log", f"{base}/log"])
    commands.main(["serve", "--log", f"{base}/log", "--output", f"{base}/board"])

    assert PredictionLog(f"{base}/log").latest(spark).count() == 6
    full = PredictionLog(f"{base}/log").windows(spark).where("days_seen = 30")
    heaviest = full.orderBy(F.desc("Vulnerability_Score")).first()
    assert (heaviest.State, heaviest.Severity_Level) == ("F", 2)
    board = f"{base}/board"
    assert spark.read.parquet(f"{board}/kpi_summary").first().states_monitored == 6
    assert spark.read.parquet(f"{board}/top_vulnerable").count() == 6
    assert {r.Location for r in spark.read.parquet(f"{board}/ranking").collect()} == {f"{s} (Rural)" for s in "ABCDEF"}
    assert spark.read.parquet(f"{base}/q").count() == 0


def test_months_and_late_reports_by_command(spark, tmp_path):
    base = str(tmp_path)
    write_csv(history(spark), f"{base}/raw.csv")
    write_csv(daily(spark), f"{base}/daily.csv")
    commands.main(["train", "--input", f"{base}/raw.csv", "--bundle", f"{base}/bundle"])
    commands.main(["send", "--input", f"{base}/daily.csv", "--folder", f"{base}/in"])
    run = ["stream", "--folder", f"{base}/in", "--bundle", f"{base}/bundle", "--log", f"{base}/log", "--calendar", "month"]
    run += ["--quarantine", f"{base}/q", "--checkpoint", f"{base}/c", "--state-partitions", "2", "--keep-late"]
    commands.main(run)
    # The second day of January comes once more, long after the month has ended.
    again = daily(spark).where("Date = '02-01-2024'")
    write_csv(again, f"{base}/again.csv")
    commands.main(["send", "--input", f"{base}/again.csv", "--folder", f"{base}/in"])
    commands.main(run)
    commands.main(["late", "--log", f"{base}/log", "--output", f"{base}/late"])

    log = PredictionLog(f"{base}/log")
    months = log.windows(spark).groupBy(F.date_format("window_start", "yyyy-MM").alias("m"), "is_closed").count().collect()
    assert sorted(map(tuple, months)) == [("2024-01", True, 6), ("2024-02", False, 6)]
    assert log.windows(spark).where("Vulnerability_Score is null").count() == 0
    late = spark.read.parquet(f"{base}/late").groupBy("window_start").agg(F.sum("late_reports"), F.sum("reports"), F.max("days_seen"))
    assert sorted((r[0].month, *r[1:]) for r in late.collect()) == [(1, 6, 6 * 32, 31), (2, 0, 6 * 19, 19)]
