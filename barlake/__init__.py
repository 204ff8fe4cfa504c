"""Daily-bar analytics on Spark DataFrames."""
