"""Relational steps: pure functions from DataFrames to DataFrames."""
