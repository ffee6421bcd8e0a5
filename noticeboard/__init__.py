"""Postings from collected web pages: extract, clean, limit, index and recheck, as Spark jobs."""
