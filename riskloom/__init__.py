"""Spark-native analysis of tabular risk data and of the classifiers trained on it."""
