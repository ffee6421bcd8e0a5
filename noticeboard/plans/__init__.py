"""Whole jobs: which sites to run, collecting their postings, rechecking old ones."""
