"""Query registry and the hand-written DuckDB oracle SQL."""
