"""Spark-native analytics for player-level football data."""
