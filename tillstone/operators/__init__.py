"""DataFrame operators: projection, quality checks and keyed upserts."""
