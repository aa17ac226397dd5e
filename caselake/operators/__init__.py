"""DataFrame-to-DataFrame operators: joins, deduplication, aggregation, nesting, limits."""
