"""Readers and connectors."""
