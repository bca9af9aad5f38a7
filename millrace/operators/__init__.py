"""Operators on record tables: staging, keys, dedup, rules, repair, quality, load."""
