"""Readers: agreement files, model definitions, run artifacts, seeds, tables."""
