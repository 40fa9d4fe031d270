"""Storyloom: a Spark-native engine for time-coded, transcribed media archives."""
