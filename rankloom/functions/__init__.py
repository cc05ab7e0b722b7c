"""Column expressions: text, markup, dates, semi-structured values."""
