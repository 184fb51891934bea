"""A PySpark-native engine for document, graph and training-data analytics."""
