"""Spark-native analytics for access logs, behavioural events and survey or price tables."""
