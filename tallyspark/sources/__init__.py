"""Readers of registry files, feeds, sheets, ledgers and request logs."""
