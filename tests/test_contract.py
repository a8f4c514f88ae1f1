"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Left out by default (``pytest -m slow`` runs them, ``oracle_check.py`` runs everything).
SLOW = {"model_roundtrip", "stream_update_log", "stream_latest", "stream_once_per_report", "stream_scored"}
SLOW |= {"stream_holed_reports", "stream_skipped", "score_windows", "severity_train", "feature_importance"}
# The text operators have tests of their own.
SLOW |= {name for name in contract.queries() if name.startswith("op") or name == "pipeline"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_expected_result_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert len(contract.entry(spark).collect()) == 10


@pytest.mark.parametrize(
    "name", [pytest.param(n, marks=pytest.mark.slow) if n in SLOW else n for n in contract.queries()]
)
def test_query(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) is None
