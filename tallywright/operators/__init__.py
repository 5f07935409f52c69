"""DataFrame operators: counts, shares, ranks, quantiles, pairs, grids, checks."""
