"""Lazy DataFrame transformations."""
