"""Composed flows: each is a chain of the operators."""
