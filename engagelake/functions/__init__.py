"""Column builders: pure expressions over columns, no actions."""
