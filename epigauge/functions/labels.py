"""Code to label lookups and the display columns built from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from epigauge.spec import REGION_LABELS, SEVERITY_COLOURS, SEVERITY_LABELS


def label_of(code: Column, labels: Mapping) -> Column:
    """The label of a code; an unknown or null code gives null."""
    chain = F
    for value, label in labels.items():
        chain = chain.when(code == F.lit(value), F.lit(label))
    return chain.otherwise(F.lit(None).cast("string"))


def region_of(code: Column, labels: Mapping = REGION_LABELS) -> Column:
    return label_of(code, labels)


def severity_of(level: Column, labels: Mapping = SEVERITY_LABELS) -> Column:
    return label_of(level, labels)


def location_of(state: Column, region: Column) -> Column:
    """``State (Region)``; null as soon as one part is null."""
    return F.concat(state, F.lit(" ("), region, F.lit(")"))


def display_class(severity: Column) -> Column:
    """Colour class of a severity label; a missing severity is shown as Unknown, not as green."""
    return F.coalesce(label_of(severity, SEVERITY_COLOURS), F.lit("Unknown"))
