"""Readers, writers and typed loading."""
