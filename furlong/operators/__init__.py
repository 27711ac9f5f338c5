"""DataFrame operators: projections, joins, checks and trailing windows."""
