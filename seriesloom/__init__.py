"""Demand-panel analytics on Spark DataFrames.

A panel is one DataFrame holding many regular time series: key columns, a time
column and measures. Every operator takes a DataFrame and returns a DataFrame
and works on all series at once.
"""

from seriesloom.spec import SeriesSpec

__all__ = ["SeriesSpec"]
