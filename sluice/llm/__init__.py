"""Corpus-preparation operators for training data, each a Spark job over the given tables."""
