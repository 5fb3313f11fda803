"""Composed runs over date folders, and the queries on the benchmark tables."""
