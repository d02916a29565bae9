"""Structured Streaming: the durable version filter and the ingestion query."""
