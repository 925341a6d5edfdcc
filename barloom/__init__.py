"""Market-bar analytics as Spark DataFrame and Structured Streaming jobs."""
