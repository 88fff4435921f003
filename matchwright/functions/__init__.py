"""Column expressions: text, names, dates, keys, scores, numbers."""
