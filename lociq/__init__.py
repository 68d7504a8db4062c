"""lociq: Spark-native analytics for mobile-element discovery data."""
