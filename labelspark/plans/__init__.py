"""Whole requests put together from the operators."""
