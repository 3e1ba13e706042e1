"""DataFrame operators that take a table from raw rows to an audited model."""
