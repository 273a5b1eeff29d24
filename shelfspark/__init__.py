"""shelfspark: Spark-native catalogue matching, cleaning and corpus preparation."""

__version__ = "0.1.0"
