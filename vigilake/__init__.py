"""vigilake: a PySpark-native fraud-analytics engine (DataFrame, SQL and Structured Streaming)."""
