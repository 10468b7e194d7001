"""Tick analytics on Spark: features, lake, labels, back-tests, accuracy, drift and monitoring."""
