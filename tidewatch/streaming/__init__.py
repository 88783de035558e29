"""Structured Streaming forms of scoring, gating, drift, service metrics and dedup."""
