"""Readers, writers and catalog helpers."""

from lakeloom.sources import catalog, files, jdbc

__all__ = ["catalog", "files", "jdbc"]
