"""Batch operators as DataFrame transformations."""
