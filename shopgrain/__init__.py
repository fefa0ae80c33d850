"""Multi-channel retail analytics on Spark DataFrames."""
