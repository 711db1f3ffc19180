"""Analytical operators: pure functions from DataFrames and parameters to a DataFrame."""
