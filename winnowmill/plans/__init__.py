"""Plan building blocks shared by operators: row positions, skew-safe joins, components, lineage cuts."""
