"""Readers: landing tables, delimited files, JSON feeds, link catalogues."""
