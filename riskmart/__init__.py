"""Spark-native credit-risk data products: cleaning, features, training, scoring and monitoring."""
