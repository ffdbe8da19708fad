"""Spark-native lakehouse and analytics for card-transaction risk."""
