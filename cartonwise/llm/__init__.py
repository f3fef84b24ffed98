"""Operators for training-data pipelines: filters, near-duplicate search, decontamination and tokenisation.

Nothing else in the package imports this folder. Every operator takes DataFrames and returns one; the registered
queries are in `queries`.
"""
