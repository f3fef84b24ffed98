"""Incremental arrival of export files."""
