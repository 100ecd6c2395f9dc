"""Operators: functions from DataFrames to DataFrames, with their columns as parameters."""
