"""Incremental intake of newly landed files."""
