"""Column expressions for cleaning, parsing and calendar features."""
