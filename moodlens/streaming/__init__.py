"""Structured Streaming entry points (the cleaning columns are stateless, so they apply unchanged)."""
