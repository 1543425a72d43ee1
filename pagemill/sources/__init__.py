"""Readers of raw material: page archives, layout and issue XML, listings, manifests, JSON lines."""
