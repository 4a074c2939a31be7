"""Readers, writers and the staging folder."""
