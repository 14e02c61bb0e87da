"""Cohort tables as Spark DataFrames: ingest, normalise, reshape, join, check."""
