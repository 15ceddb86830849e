"""Whole programs composed from operators."""
