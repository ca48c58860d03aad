"""Aggregation of sparse spatiotemporal observations onto hierarchical grids, on Spark."""
