"""Readers, writers and generated dimensions."""
