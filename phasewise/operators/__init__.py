"""Relational operators: filters, joins, reshaping, aggregation, ranks."""
