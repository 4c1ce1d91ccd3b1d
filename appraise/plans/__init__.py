"""Plans: the registered queries (one per operator of the inventory), their DuckDB oracle texts,
the end-to-end cleaning / feature / model / scoring jobs."""
