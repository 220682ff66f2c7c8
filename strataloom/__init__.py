"""strataloom: a PySpark-native engine for document corpora and the graphs built from them."""
