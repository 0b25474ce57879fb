"""DataFrame operators: quality rules, splits, statistics, running sums and metrics."""
