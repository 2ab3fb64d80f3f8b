"""Spark jobs for demonstration-trajectory datasets."""
