"""Training-data operators: ten corpus operators and the queries built on them.

Nothing else in the library imports this subpackage.
"""
