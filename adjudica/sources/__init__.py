"""Readers, writers and the adapter over the test tables."""
