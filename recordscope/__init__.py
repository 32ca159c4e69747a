"""Public-records analytics as functions from DataFrames to DataFrames."""
