"""fundlab: a PySpark-native engine for ranking investment funds and preparing text corpora."""
