"""Streaming topics and stored tables."""
