"""Readers and writers: landed pages, CSV datasets, versioned warehouse tables."""
