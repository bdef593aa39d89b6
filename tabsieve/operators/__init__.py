"""DataFrame operators: clean, encode, enrich, joins, text, stats, model."""
