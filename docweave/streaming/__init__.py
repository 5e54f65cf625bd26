"""Streaming registration of a landing folder."""
