"""Column functions: text rules, symbol naming, language and emotion scores."""
