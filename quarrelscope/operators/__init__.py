"""Relational operators over pages and revisions."""
