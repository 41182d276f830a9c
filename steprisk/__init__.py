"""Point-in-time transaction-risk analytics on Spark DataFrames."""
