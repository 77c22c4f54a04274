"""Research data operators on Spark DataFrames."""
