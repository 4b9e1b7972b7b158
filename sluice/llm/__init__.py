"""Operators and queries for the preparation of training data."""
