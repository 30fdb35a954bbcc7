"""Subscriber-churn analytics on Spark DataFrames and streams."""
