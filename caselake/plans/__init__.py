"""Whole pipelines, and the catalogue of queries with the SQL they are held against."""
