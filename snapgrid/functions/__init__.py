"""Column functions: time, numbers, text and port predicates."""
