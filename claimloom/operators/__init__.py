"""Operators over DataFrames; column names are parameters, nothing here knows the claims domain."""
