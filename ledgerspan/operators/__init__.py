"""Operators: functions from DataFrames to DataFrames.  Only ``stored`` and ``enforce`` run jobs."""
