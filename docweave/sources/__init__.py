"""Readers and writers at the edge: listings, texts, delimited lists, OCR input."""
