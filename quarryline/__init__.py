"""Quarryline: config-driven extraction and tabular operators on Apache Spark.

Everything is a function over Spark DataFrames or Columns; see README.md for the tour.
"""
