"""Plan shapes shared by several operators: ordered totals, lookups, the training table."""
