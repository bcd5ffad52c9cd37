"""Readers, writers and table registration."""
