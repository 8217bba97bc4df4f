"""DuckDB oracle SQL for the registered queries (the driver's correctness gate)."""
