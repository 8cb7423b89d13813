"""Per-pixel time-series analytics on Spark DataFrames."""
