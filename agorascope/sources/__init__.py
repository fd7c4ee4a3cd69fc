"""Readers, writers and message parsing."""
