"""Spatial and trajectory analytics on Spark DataFrames."""
