"""Relational operators over detections, tracks, vectors and groups."""
