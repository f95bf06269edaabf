"""Operators of a training-data pipeline: scoring, de-duplication, privacy, extraction, tokens."""
