"""Relational operators of the page collection."""
