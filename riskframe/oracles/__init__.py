"""DuckDB oracle SQL: independent plain-window formulations of each operator."""
