"""Operators of a training-data pipeline: cleaning, joining, counting and mixing of documents."""
