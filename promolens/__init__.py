"""PySpark-native promotion-parity analytics."""
