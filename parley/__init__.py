"""Call-analytics operators for Spark DataFrames."""
