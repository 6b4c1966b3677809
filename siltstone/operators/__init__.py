"""Relational and Arrow-backed operators."""
