"""Plans: the query catalog (Spark builder + DuckDB oracle per operator) and pipeline composition."""
