"""DataFrame -> DataFrame operators: data quality, engagement, ranking, joins."""
