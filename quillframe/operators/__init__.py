"""The operators, one module per kind of work."""
