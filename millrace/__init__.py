"""Config-driven database ingestion and job ledger, expressed as Spark DataFrame jobs."""
