"""Marketing-data jobs on Spark: plain functions from DataFrames to DataFrames."""
