"""Schedule-adherence analytics on Spark DataFrames."""
