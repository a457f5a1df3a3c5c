"""Readers, writers, schemas and constraint checks."""
