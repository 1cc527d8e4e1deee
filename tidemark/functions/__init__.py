"""Column expressions: numbers, calendar, text, distance, bands and mart measures."""
