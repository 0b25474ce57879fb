"""Delimited text in and out."""
