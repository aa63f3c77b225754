"""Readers for the raw tables and the fixtures derived from the test tables."""
