"""Column expressions: dates and zones, derived amounts, JSON text."""
