"""Lectern subpackage; see README for the map of operators."""
