"""Spark-native analytics for game telemetry: DataFrame in, DataFrame out."""
