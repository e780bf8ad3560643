"""Column -> Column functions: parsers, cleaners, RSI formulas, day arithmetic."""
