"""Column-level building blocks: time, predicates, scalars, schema walks, ordered and quantile helpers."""
