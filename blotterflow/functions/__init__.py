"""Column functions: text, dates, and ordered rules."""
