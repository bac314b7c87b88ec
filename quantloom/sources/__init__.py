"""Readers, writers and the panels that are derived from the base tables."""
