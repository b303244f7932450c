"""Operators on DataFrames: contracts, ledgers, merges, rollups, reads, publication."""
