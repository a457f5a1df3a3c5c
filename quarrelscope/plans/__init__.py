"""Whole plans: the warehouse and the named queries."""
