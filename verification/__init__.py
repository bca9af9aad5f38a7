"""Queries over the given tables, each with SQL that must agree with it."""
