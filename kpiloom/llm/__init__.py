"""Operators for preparing training text, each a function from DataFrames to a DataFrame.

Nothing outside this folder imports it, but for the entry module and the
corpus pipeline.  `queries` binds the operators to the driver tables.
"""
