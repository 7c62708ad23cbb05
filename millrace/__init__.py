"""millrace: a Spark-native engine for row-change analytics."""
