"""Meter-reading analytics on Spark: clean, enrich, featurise, forecast, score, rank."""

__version__ = "0.1.0"
