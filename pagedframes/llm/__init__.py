"""Operators for large corpora of training text, and the queries that apply them to whole tables."""
