"""winnowmill: Spark-native auditing, correction and enrichment of labeled tables and texts."""

__version__ = "0.1.0"
