"""Compositions: the end-to-end build, the query registry and its oracle."""
