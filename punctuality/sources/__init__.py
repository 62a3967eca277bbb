"""Readers, writers and the derived test table."""
