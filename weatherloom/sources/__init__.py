"""Batch sources: files, databases, topics, and the schema report."""
