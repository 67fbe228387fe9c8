"""Structured Streaming front ends of the merge operators."""
