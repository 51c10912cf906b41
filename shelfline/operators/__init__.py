"""DataFrame to DataFrame operators, grouped by kind."""
