"""Readers, writers and the mapping of the test tables."""
