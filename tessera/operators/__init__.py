"""Operators: DataFrames in, DataFrames out, with columns as parameters."""
