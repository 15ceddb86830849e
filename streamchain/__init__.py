"""Ordered block and message logs as Spark DataFrames."""
