"""Queries over the given tables: every operator and pipeline, with its twin in plain SQL."""
