"""Incremental runs of the rule-driven job with Structured Streaming."""
