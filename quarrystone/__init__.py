"""Company-record resolution and training-data jobs on Spark DataFrames."""
