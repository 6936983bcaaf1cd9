"""DataFrame operators: filters, joins, aggregates, ranking, graph, alerts."""
