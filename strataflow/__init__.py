"""Layered (Bronze, Silver, Gold) analytics on Spark DataFrames."""
