"""Operators and queries of a training-data pipeline, each a Spark job on whole tables."""
