"""Relational and table operators."""
