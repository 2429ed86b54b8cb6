"""Star ratings against what the words say: review analytics on Spark DataFrames."""
