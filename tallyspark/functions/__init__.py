"""Column functions: text, dates, addresses, hashes."""
