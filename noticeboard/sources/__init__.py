"""Readers and the versioned posting table."""
