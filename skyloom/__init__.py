"""Geo, text, vector and time-series analytics as Spark DataFrame operators."""
