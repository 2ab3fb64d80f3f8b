"""Operators on frames, episodes, plans and images."""
