"""Interval-consensus analytics and training-data operators on Spark DataFrames."""
