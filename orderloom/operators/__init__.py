"""DataFrame operators: version picks, incremental loads, merges, history, checks."""
