"""Review-sentiment warehouse on Spark DataFrames."""
