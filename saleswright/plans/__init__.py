"""Queries over the cleaned sales table."""
