"""A PySpark-native analytics engine for archives of signed, tagged events."""
