"""Training-data pipeline operators (mixing, token counts, joins, search, encoding, ...)."""
