"""Incremental versions of the rolling features as Structured Streaming queries."""
