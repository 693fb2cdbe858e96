"""Operators: functions from DataFrames to DataFrames, for batch and (where noted) streams."""
