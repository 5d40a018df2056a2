"""Operators for training-data pipelines (documents, pages, benchmark tables)."""
