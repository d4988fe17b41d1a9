"""Streaming forms of the workflow operators."""
