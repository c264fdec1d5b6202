"""Structured Streaming twins of the 30-minute cadence."""
