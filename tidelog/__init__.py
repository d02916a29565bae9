"""Versioned change messages to queryable, auditable tables, on Spark DataFrames."""
