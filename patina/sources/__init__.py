"""Readers, writers and collection selection."""
