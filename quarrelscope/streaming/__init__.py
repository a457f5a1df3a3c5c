"""Incremental use over unbounded edit logs; the batch operators are the specified behaviour."""
