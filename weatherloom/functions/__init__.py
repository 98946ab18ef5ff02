"""Column expressions: ladders, bands, derived measures, text and time helpers."""
