"""Plans: registered queries, one-table and multi-table runs, run state and metrics."""
