"""Structured Streaming front ends."""
