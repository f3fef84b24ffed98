"""Readers and writers: star-schema tables, export files, the line store, contacts, extracts, JSON."""
