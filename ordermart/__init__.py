"""Spark-native customer/order sales engine."""
