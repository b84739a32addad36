"""Traffic analytics on Spark: frames to counts, window averages, forecasts and serving tables."""
