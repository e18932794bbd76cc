"""Table-level operators: fields, query predicates, category mapping, quality rules, sync."""
