"""A PySpark-native analytics engine for play-by-play sports data."""
