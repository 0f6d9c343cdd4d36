"""Tessera: dataset engineering on Spark DataFrames."""
