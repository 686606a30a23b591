"""Document-corpus operators for Spark DataFrames."""
