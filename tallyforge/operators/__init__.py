"""Table operators that take column names and value lists: joins, rollups, pivots, history, checks."""
