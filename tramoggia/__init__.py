"""Spark-native preparation and analysis of language-model training corpora."""

__version__ = "0.1.0"
