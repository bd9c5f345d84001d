"""Scans of files and tables, and the stored collection."""
