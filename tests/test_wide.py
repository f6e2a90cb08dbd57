"""The wide pivot keeps every row, however many suppliers there are."""

from pyspark.sql import functions as F

from cohortspark.operators import timetable
from cohortspark.plans.catalog import QUERIES, REMAINDERS


def test_every_row_is_counted(spark, tmp_path):
    li = spark.range(3000).select((F.col("id") % 7).alias("l_partkey"), (F.col("id") + 1).alias("l_suppkey"), F.lit(2.0).alias("l_quantity"))
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = QUERIES["wide_table_whole"](spark, str(tmp_path)).collect()
    assert sum(r[f"cnt_{k}"] for r in rows for k in REMAINDERS) == 3000


def test_tasks_hold_no_wide_rows(spark):
    """Beyond the limit no aggregate has a buffer of the full width, and the cells are the same."""
    rows = [(1, 2, 4.0), (1, 2, None), (1, 300, 8.0), (None, 0, 1.0), (None, 0, 2.0), (3, 5, None), (4, 999, 1.0), (5, None, 1.0)]
    df = spark.createDataFrame(rows, "k long, item int, v double")
    stats = {"avg_{value}": ("avg", "v"), "min_{value}": ("min", "v"), "max_{value}": ("max", "v"), "sum_{value}": ("sum", "v"), "n_{value}": ("count", "v")}
    wide = timetable.spread(df, ["k"], "item", list(range(301)), stats)
    assert "pivotfirst" not in wide._jdf.queryExecution().executedPlan().toString().lower()
    assert wide.columns == ["k", *(t.format(value=v) for v in range(301) for t in stats)]
    found = {r["k"]: {c: x for c, x in r.asDict().items() if x and c != "k"} for r in wide.collect()}
    cells = lambda v, *x: dict(zip((f"{s}_{v}" for s in ("avg", "min", "max", "sum", "n")), x))
    assert found == {1: cells(2, 4.0, 4.0, 4.0, 4.0, 1) | cells(300, 8.0, 8.0, 8.0, 8.0, 1), None: cells(0, 1.5, 1.0, 2.0, 3.0, 2), 3: {}}
    empty = next(r for r in wide.collect() if r["k"] == 3)
    assert empty["n_5"] == 0 and empty["n_6"] == 0 and empty["avg_5"] is None and empty["sum_6"] is None
