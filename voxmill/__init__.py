"""A Spark-native engine for curating speech corpora and text corpora."""
