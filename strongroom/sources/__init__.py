"""Readers, writers and the staging feeds derived from the test tables."""
