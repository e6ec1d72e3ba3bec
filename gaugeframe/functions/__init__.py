"""Column expressions: text cleaning, timestamp parsing, exact statistics."""
