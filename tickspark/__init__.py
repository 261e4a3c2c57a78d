"""PySpark-native analytics for market event data."""
