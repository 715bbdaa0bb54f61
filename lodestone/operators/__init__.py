"""Operators over flagged, weighted visibility tables."""
