"""Record, transcript and corpus jobs over Spark DataFrames."""
