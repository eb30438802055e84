"""Column expressions: trip features, rules, text and grades."""
