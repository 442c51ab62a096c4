"""Readers, writers and the snapshot table layer."""
