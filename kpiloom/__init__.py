"""Operational KPI reports as Spark jobs.

Every report is a function from DataFrames (plus an ``as_of`` date and small
configuration values) to a DataFrame.  Nothing is evaluated on the driver: the
functions only build a plan.
"""
