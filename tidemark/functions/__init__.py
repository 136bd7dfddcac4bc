"""Column expressions: calendar, pricing, cleansing and enrichment."""
