"""Governed data pipelines as Spark DataFrame jobs."""
