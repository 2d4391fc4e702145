"""Report views, the warehouse, and the query catalogue."""
