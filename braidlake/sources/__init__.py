"""Readers, writers and staged intermediates."""
