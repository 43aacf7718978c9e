"""Column -> Column functions; everything stays inside code generation."""
