"""Site-relative line dedup on hand-made pages."""

from cohortspark.llm.common import prepare
from cohortspark.llm.line_dedup import boilerplate, drop_boilerplate

SCHEMA = "id long, text string, source string, n_lines string, _host string"


def frame(spark, rows):
    return prepare(spark).createDataFrame([(k, t, s, "x", "y") for k, (t, s) in enumerate(rows)], SCHEMA)


def run(spark, rows, **options):
    out = drop_boilerplate(frame(spark, rows), **options).orderBy("id").collect()
    return [(r["text"], r["n_lines"], r["n_dropped"]) for r in out]


def test_ratio_is_of_the_host(spark):
    rows = [("menu\nown %d" % k, "a") for k in range(4)] + [("menu\nother", "b")] + [("b %d" % k, "b") for k in range(40)]
    out = run(spark, rows, ratio=0.5, min_pages=3)
    assert out[:4] == [("own %d" % k, 2, 1) for k in range(4)]
    assert out[4] == ("menu\nother", 2, 0)


def test_a_line_counts_once_a_page_and_small_hosts_keep_all(spark):
    rows = [("x\nx\nx\nx", "a"), ("y", "a"), ("z", "a"), ("q", "b"), ("q", "b")]
    assert [r[2] for r in run(spark, rows, ratio=0.1, min_pages=3)] == [0, 0, 0, 0, 0]


def test_nulls_blanks_repeats_and_unknown_hosts(spark):
    rows = [(None, None), ("", None), ("\n \nfoot", None), ("foot", None), ("foot", None), ("foot\n" + "long " * 50_000, None)]
    out = run(spark, rows, ratio=0.5, min_pages=3)
    assert out[0] == (None, 0, 0) and out[1] == ("", 1, 0)
    assert out[2] == ("\n ", 3, 1) and out[3] == out[4] == ("", 1, 1) and out[5] == ("long " * 50_000, 2, 1)


def test_empty_table_and_columns(spark):
    df = frame(spark, [])
    assert boilerplate(df).collect() == [] and drop_boilerplate(df).collect() == []
    assert drop_boilerplate(df).columns == ["id", "text", "source", "_host", "n_lines", "n_dropped"]
