"""A Spark-native engine: nested incident signals -> events -> draft alerts, batch and streaming."""
