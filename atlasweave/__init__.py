"""Spark-native map, gazetteer and graph analytics."""
