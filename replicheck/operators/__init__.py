"""Operators of the check and the repair, each from DataFrames to a DataFrame."""
