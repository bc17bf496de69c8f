"""Spark-first analytics for short-RNA reads and for text corpora."""
