"""Spark-native engine for screening large collections of bibliographic evidence."""
