"""Plans: wiring of stages (silver -> gold -> marts -> serving), the query
registry used by the driver contract, and the DuckDB oracle SQL."""
