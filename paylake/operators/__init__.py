"""Table-to-table steps. Each takes and returns a DataFrame."""
