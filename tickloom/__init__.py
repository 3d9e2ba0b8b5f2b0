"""Tick-level market analytics on Spark DataFrames and Structured Streaming."""
