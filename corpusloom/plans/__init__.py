"""Composed jobs: corpus processing, ingest, hybrid search, recall benchmark."""
