"""Operators composed to the stages of an analysis."""
