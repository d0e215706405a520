"""A PySpark-native engine for typed facts, graphs, evidence and retrieval."""
