"""Spark-first operators for volumetric imaging tables."""
