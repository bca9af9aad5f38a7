"""Envelopes and their ingestion."""
