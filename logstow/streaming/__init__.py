"""Continuous archiving with Structured Streaming."""
