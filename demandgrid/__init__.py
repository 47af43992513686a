"""Hourly demand forecasting on Spark DataFrames."""

from demandgrid.session import build_session

__all__ = ["build_session"]
