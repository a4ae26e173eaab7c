"""Column expressions: scalars, predicates, text and distance."""
