"""Relations to read from: JDBC databases, lake tables, config tables."""
