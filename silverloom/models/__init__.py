"""Encoders, classifiers and projections on Spark ML."""
