"""Queries over the synthetic tables, with SQL that gives the same rows."""
