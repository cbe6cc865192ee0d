"""Document ingestion, registration and reconciliation as Spark DataFrame jobs."""
