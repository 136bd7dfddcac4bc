"""DataFrame operators: typing, keyed selection, joins, analysis, quality."""
