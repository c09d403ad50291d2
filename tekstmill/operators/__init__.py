"""DataFrame in, DataFrame out: filters, deduplication, table cleaning, statistics."""
