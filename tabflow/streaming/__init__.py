"""Structured Streaming delivery of batch scoring (M21 on arriving files)."""
