"""terralume: a Spark-native engine for multi-source listing data."""
