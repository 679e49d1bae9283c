"""Spark-native analytics for environmental point observations and gridded time series."""
