"""Cohort building and time-series feature engineering on Spark DataFrames."""

from cohortspark.session import configure, inline

__all__ = ["configure", "inline"]
