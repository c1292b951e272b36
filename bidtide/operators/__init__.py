"""Batch (and, where noted, streaming) DataFrame operators."""
