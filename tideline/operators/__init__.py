"""Operators: functions from DataFrame to DataFrame, column names as arguments."""
