"""Column expressions: pointers, value rendering, equality and keyed draws."""
