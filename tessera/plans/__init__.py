"""Whole pipelines built from operators."""
