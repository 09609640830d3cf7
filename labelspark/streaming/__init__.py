"""Refreshed tables and continuous label work."""
