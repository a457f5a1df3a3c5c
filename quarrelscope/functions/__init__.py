"""Column expressions: strings, paths, titles, numbers."""
