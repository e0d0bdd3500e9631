"""Land-use knowledge analytics on Spark DataFrames."""
