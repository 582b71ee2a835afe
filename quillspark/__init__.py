"""A PySpark-native engine for transcript corpora and the batch-inference runs made over them."""
