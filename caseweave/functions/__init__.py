"""Column functions: label predicates, text shaping, times."""
