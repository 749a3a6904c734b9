"""Column expressions: cleaning rules, encodings, dates and status lights."""
