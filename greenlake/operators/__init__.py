"""Operators that take DataFrames and return DataFrames."""
