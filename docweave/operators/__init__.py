"""Relational operators of the process: queues, matching, upsert, OCR roll-ups, metrics."""
