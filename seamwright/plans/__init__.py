"""Queries over the standard tables."""
