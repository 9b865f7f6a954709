"""Operators for building language-model training corpora, each a function from DataFrame to DataFrame."""
