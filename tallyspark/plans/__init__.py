"""Composed jobs, and the queries over the driver tables."""
