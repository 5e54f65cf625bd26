"""Column functions: paths, replacement, personal data, dates."""
