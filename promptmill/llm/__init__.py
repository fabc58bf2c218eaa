"""Operators of a training-data pipeline: filters, duplicates, tokenizing, token files."""
