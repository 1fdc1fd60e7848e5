"""Spark-native operators for sales, sensor, click and customer-value data."""
