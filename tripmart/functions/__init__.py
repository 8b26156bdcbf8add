"""Column expressions: typing, hashing and derived measures."""
