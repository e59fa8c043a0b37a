"""Batch analytics on retail event logs with PySpark DataFrames."""
