"""Operators on streams of files."""
