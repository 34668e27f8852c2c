"""Operators for building training data for language models, and their registered queries."""
