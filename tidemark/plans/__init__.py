"""Compositions of operators: metrics, presentation tables and end-to-end jobs."""
