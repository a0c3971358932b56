"""Column functions: text, hashes, patterns, decisions, and the Python functions behind UDFs."""
