"""Readers and writers of array and mesh files."""
