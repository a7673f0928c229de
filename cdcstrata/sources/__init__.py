"""Readers, writers, table definitions and shared scratch space."""
