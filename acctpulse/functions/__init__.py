"""Column builders and presentation helpers."""
