"""Streaming: the ETL as an incremental Structured Streaming query."""
