"""Text mining on Spark DataFrames."""
