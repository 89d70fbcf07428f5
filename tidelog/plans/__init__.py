"""Plan shapes shared by the operators: hot-key splitting and overlapping tiles."""
