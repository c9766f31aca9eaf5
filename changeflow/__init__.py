"""A change-mirroring engine on Spark DataFrames and Structured Streaming."""
