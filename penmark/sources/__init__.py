"""Readers and writers for author lists, URL indexes, article stores and snapshots."""
