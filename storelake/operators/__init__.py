"""Table-level operators: versions, loads, quantiles, checks, pivots."""
