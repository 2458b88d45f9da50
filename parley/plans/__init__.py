"""Jobs that chain sources and operators, and the query catalogue."""
