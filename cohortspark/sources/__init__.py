"""Reading source and lookup tables, writing results."""

from cohortspark.sources.sinks import materialize, register, save_bucketed, save_csv, save_partitioned
from cohortspark.sources.tables import load, load_lookup, read_jdbc

__all__ = ["load", "load_lookup", "materialize", "read_jdbc", "register", "save_bucketed", "save_csv", "save_partitioned"]
