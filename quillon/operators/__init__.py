"""Operators of the factor model: each takes DataFrames and returns a lazy DataFrame."""
