"""Reusable ``DataFrame -> DataFrame`` operators."""
