"""Operators of a training-data pipeline, each with one registered query (see queries.py)."""
