"""DataFrame operators; each takes a table and returns a table."""
