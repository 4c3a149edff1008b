"""Equity bar analytics and table operators on Spark DataFrames."""
