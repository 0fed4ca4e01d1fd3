"""Streams over files that arrive."""
