"""Column expressions: casts, data-quality rules, keys and business enrichment."""
