"""docweave: a PySpark-native engine for documentation corpora."""
