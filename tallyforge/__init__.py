"""Spark-native analytics over product listings, crawls and text corpora."""
