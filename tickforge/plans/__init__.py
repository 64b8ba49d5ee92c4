"""Jobs over the driver's tables: derived market views, registered queries and
their DuckDB oracle SQL."""
