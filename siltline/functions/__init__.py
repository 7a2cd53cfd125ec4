"""Column expressions: text, numbers, dates, names and typed casts."""
