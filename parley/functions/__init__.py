"""Column expressions; every one is a built-in Catalyst expression."""
