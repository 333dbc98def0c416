"""A PySpark-native engine for curating labelled image-text corpora."""
