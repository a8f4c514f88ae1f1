"""Public-health surveillance analytics on Spark: windowed indicators, severity and vulnerability."""

from epigauge.spec import IndicatorSpec

__all__ = ["IndicatorSpec"]
