"""Operators of a training-data pipeline, built on Spark.

Nothing outside this folder imports it; it imports only general helpers
(``footfall.session``). Every operator takes DataFrames and returns
DataFrames. ``queries`` holds the thin registered queries.
"""
