"""Readers for tables and CSV files."""
