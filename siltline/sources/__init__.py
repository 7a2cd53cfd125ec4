"""Readers for delimited exports and their headers."""
