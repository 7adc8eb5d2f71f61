"""Retail price intelligence on Spark: every operator maps DataFrames to DataFrames."""
