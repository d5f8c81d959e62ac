"""Queries on the given tables. Importing this package registers them all."""

from . import analogs, analysis, forecast, indicators, joins, landing, long_series, projections, stored
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analogs", "analysis", "forecast", "indicators", "joins", "landing", "long_series", "projections", "stored"]
