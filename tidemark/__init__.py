"""Spark-native time-series and records analytics: lazy DataFrame -> DataFrame operators."""
