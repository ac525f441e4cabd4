"""Readers, sinks, table writers and the adapters for the sample tables."""
