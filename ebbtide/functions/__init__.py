"""Column expressions: category rules, calendar attributes and ratios."""
