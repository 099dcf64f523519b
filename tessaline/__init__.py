"""Spark-native analytics for gridded observations, tiles and vector layers."""
