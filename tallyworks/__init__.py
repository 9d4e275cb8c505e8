"""Analytics operators written directly on Spark DataFrames and Structured Streaming."""
