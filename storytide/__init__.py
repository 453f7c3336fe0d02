"""Emotional-arc analytics for large text corpora, written as Spark DataFrame jobs."""
