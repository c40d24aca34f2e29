"""Driving-scenario analytics on Spark DataFrames."""
