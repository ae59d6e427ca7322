"""Readers and landing for source extracts (bronze) and version-controlled seeds."""
