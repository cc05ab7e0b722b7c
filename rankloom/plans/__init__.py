"""Operators composed into the ingest, search and evaluation flows."""
