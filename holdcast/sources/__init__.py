"""Readers, writers and the fixture mapping from the driver's tables."""
