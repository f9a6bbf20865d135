"""Operators from DataFrame to DataFrame, one module per concern."""
