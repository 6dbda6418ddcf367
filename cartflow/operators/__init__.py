"""Batch operators: functions from DataFrame to DataFrame."""
