"""Cleaning rules on literal rows."""

from __future__ import annotations

import pytest

from epigauge.operators.cleaning import (
    cleaning_report,
    column_report,
    completeness_report,
    indicator_columns,
    keep_complete,
    keep_nonzero,
    numeric_columns,
)
from epigauge.functions.numeric import any_nonzero
from epigauge.spec import IndicatorSpec
from epigauge.operators.features import assembler
from epigauge.sources.tables import preview, read_csv, require_columns, write_csv

NAN = float("nan")


@pytest.fixture
def mixed(spark):
    data = [("a", 0, None), ("b", 0, 0.0), ("c", None, 1.0), ("d", 5, None), ("e", None, None)]
    return spark.createDataFrame(data, "name string, i bigint, x double")


def test_numeric_columns_cover_all_number_types_but_keys(spark):
    df = spark.createDataFrame(
        [], "k int, a int, b bigint, c double, d float, e decimal(10,2), f smallint, s string, t date"
    )
    assert numeric_columns(df, exclude=["k"]) == ["a", "b", "c", "d", "e", "f"]


def test_keep_nonzero_treats_null_as_no_difference(mixed):
    assert [r.name for r in keep_nonzero(mixed, ["i", "x"]).orderBy("name").collect()] == ["c", "d"]


def test_no_numeric_column_is_an_error():
    with pytest.raises(ValueError):
        any_nonzero([])


def test_reports(mixed):
    assert cleaning_report(mixed, ["i", "x"]).first() == (5, 2, 3)
    assert {r.column_name: (r.nonzero_rows, r.missing_rows) for r in column_report(mixed, ["i", "x"]).collect()} == {
        "i": (1, 2),
        "x": (1, 3),
    }


def test_null_and_nan_rows_are_skipped_as_the_assembler_does(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (NAN, 2.0), (3.0, 4.0)], "x double, y double")
    assert keep_complete(df, ["x", "y"]).count() == 2
    assert completeness_report(df, ["x", "y"]).first() == (4, 2, 2)
    assert assembler(["x", "y"], "v", "skip").transform(df).count() == 2


def test_training_assembler_refuses_holes(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception, match="null|invalid"):
        assembler(["x"], "v").transform(df).collect()


def test_csv_with_and_without_schema(spark, mixed, tmp_path, rows):
    path = str(tmp_path / "csv")
    write_csv(mixed, path)
    assert rows(read_csv(spark, path, mixed.schema)) == rows(mixed)
    assert read_csv(spark, path).dtypes == [("name", "string"), ("i", "int"), ("x", "double")]
    with pytest.raises(ValueError, match="Severity_Level"):
        read_csv(spark, path, needs=["Severity_Level"])


def test_preview_and_guard(mixed):
    assert [r.name for r in preview(mixed, ["name"], 2).collect()] == ["a", "b"]
    assert require_columns(mixed, ["i"]) is mixed


def test_calendar_columns_are_no_metrics(spark):
    """A year is never zero: a row without indicators must go all the same."""
    spec = IndicatorSpec(metrics=("a",), burden=("a",))
    df = spark.createDataFrame([("A", 2024, 1, 0.0, 5), ("B", 2024, 2, 3.0, 0)], "State string, Year int, Month int, a double, b int")
    assert indicator_columns(df, spec) == ["a"]
    unknown = df.withColumnRenamed("a", "c")
    assert indicator_columns(unknown, spec) == ["c", "b"]
    assert indicator_columns(unknown, spec, exclude=["b"]) == ["c"]
    assert [r.State for r in keep_nonzero(df, indicator_columns(df, spec)).collect()] == ["B"]
