"""Column expressions: label maps, times and steps."""
