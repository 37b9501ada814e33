"""Operators for cleaning training text at corpus scale, each a Spark job over DataFrames."""
