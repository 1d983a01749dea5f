"""Quarry: a Spark-native analytics engine for corporate disclosure corpora."""
