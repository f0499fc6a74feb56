"""Readers, writers and intermediate tables."""
