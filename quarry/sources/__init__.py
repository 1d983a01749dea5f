"""Readers, sinks and stand-in relations."""
