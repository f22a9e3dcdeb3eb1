"""Readers, writers and storage-level operators."""
