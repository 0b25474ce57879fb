"""Tabular learning jobs on Spark DataFrames: clean, derive, split, train, score, measure, write."""

__version__ = "0.1.0"
