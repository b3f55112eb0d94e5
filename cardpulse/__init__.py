"""Transaction-risk features as Spark DataFrame operators, for batch tables and Structured Streaming alike."""
