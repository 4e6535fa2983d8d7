"""DataFrame operators: projection, filters, joins, deduplication, reshaping, checks, profiles."""
