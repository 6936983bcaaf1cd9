"""Column-level building blocks: projections, row-wise arrays, score bands."""
