"""Governance and observability analytics for language-model traffic, as Spark jobs."""
