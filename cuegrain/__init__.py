"""Spark-native analytics over timed transcripts and document collections."""
