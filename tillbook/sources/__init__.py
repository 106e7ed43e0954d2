"""Readers and landing jobs."""
