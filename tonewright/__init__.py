"""Text classification on Spark DataFrames."""
