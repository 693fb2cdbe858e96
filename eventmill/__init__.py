"""Event analytics and order-saga jobs on Spark DataFrames and Structured Streaming."""
