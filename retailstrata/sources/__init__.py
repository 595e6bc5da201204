"""Scans of raw extracts and reads and writes of layer tables."""
