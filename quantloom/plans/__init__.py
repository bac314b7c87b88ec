"""Composed tables and registered queries."""
