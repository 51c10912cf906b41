"""Column expressions: text, taxonomy paths, maps, dates."""
