"""Scans: manifest listing, binary files, layout sheets."""
