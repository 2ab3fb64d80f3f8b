"""Recipes and end-to-end jobs."""
