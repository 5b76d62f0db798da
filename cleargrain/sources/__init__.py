"""Readers, the adapter over the given tables, and sinks."""
