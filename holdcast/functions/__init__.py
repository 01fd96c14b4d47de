"""Column expressions: unit conversions, ratios, date helpers."""
