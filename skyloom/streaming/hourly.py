"""``hourly_agg`` over a stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyloom.operators.weather import TIME, hourly_agg


def hourly_stream(
    readings: DataFrame, metric: str = "temperature", time_col: str = TIME, lateness: str = "2 hours"
) -> DataFrame:
    """Hours of a streaming ``readings``; an hour is final once the watermark has passed its end."""
    if not readings.isStreaming:
        raise ValueError("readings must be a streaming DataFrame")
    return hourly_agg(readings.withWatermark(time_col, lateness), metric, time_col)
