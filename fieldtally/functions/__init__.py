"""Column-level building blocks: names, periods, casts and rates."""
