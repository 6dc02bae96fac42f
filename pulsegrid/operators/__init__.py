"""Relational operators on status and user tables."""
