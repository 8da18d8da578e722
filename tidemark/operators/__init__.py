"""Operators on Spark DataFrames."""
