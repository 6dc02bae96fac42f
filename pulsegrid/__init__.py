"""PySpark-native analytics for social-media status data, on tables and on streams."""
