"""Profiling, validation, deduplication, reconciliation and audit jobs."""
