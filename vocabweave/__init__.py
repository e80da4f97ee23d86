"""Spark jobs that weave many vocabularies into one concept graph."""
