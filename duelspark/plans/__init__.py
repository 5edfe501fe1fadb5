"""Whole pipelines, and the queries registered for checking."""
