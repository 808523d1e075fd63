"""Readers, writers and the fixtures that derive race data from the driver tables."""
