"""Readers, writers and the shared scratch space."""
