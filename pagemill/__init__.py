"""Spark-native analytics over large collections of scanned-page documents."""
