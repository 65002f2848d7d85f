"""File-arrival load and mart refresh (Structured Streaming)."""
