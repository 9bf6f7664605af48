"""Table operators: keyed lookups, de-duplication, references, rules, constraints."""
