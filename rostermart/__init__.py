"""Workforce analytics on Spark DataFrames."""
