"""Advertising-share analytics on Spark DataFrames."""
