"""DataFrame operators: filters, joins, aggregates, sequences, nested data, checks."""
