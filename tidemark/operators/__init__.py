"""DataFrame operators: versions, normalisation, calendars, point-in-time queries, futures, quality, liquidity."""
