"""Trip time series on Spark: clean, aggregate, score, maintain and stream."""
