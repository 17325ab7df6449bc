"""A PySpark-native engine for audio-scene and time-series data."""
