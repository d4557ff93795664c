"""Whole jobs: raw files to tables, and reports over the tables."""
