"""Readers, writers and the shared folder they stage in."""
