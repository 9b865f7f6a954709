"""Labelled-text medallion pipelines as Spark DataFrame operators."""
