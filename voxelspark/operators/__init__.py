"""Operators over voxel, box, embedding, mesh and workflow tables."""
