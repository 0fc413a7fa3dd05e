"""Forecast-versus-market analytics on Spark DataFrames."""
