"""Column expressions: text codes, dates and times, numbers."""
