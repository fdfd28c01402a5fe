"""Readers, writers and the fixtures derived from the test tables."""
