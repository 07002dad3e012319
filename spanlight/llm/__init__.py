"""Operators of a training-data pipeline: ten corpus operators, each a function of DataFrames."""
