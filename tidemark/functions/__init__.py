"""Column functions: predicates, time rules, hashing."""
