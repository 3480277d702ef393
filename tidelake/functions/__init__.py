"""Column functions: names, time, payload keys and hashes."""
