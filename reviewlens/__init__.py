"""Deceptive-review analytics on Spark DataFrames."""
