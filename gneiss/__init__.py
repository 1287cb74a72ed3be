"""gneiss: a PySpark-native engine for nested-archive, document-centric analytics."""
