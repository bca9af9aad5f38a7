"""Operators put together."""
