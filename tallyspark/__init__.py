"""Audited public-records analytics on Spark."""
