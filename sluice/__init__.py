"""Sluice: record mapping, routing, change streams and stream metrics on Spark DataFrames."""
