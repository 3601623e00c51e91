"""DataFrame -> DataFrame operators: parse, joins, spatial join, aggregates, replay."""
