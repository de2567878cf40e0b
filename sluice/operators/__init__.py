"""DataFrame -> DataFrame operators: header conformance, validation, joins, enrichment."""
