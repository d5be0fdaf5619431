"""Brokerage analytics and rule-checked ingestion as Spark jobs."""
