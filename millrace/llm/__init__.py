"""Operators for preparing training text: scans, filters, joins, deduplication, packing and archives.

Nothing else in the library imports this subpackage.
"""
