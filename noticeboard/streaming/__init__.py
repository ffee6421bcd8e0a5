"""Continuous indexing of finished batches."""
