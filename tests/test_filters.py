import datetime as dt

from pyspark.sql import functions as F

from linkgraph.operators import filters as Fl
from tests.conftest import rows


def test_isin_and_not_in_drop_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(Fl.filter_isin(df, "c", ["a"])) == [("a",)]
    assert rows(Fl.filter_isin(df, "c", ["a"], not_in=True)) == [("b",)]


def test_length_bounds_inclusive(spark):
    df = spark.createDataFrame([("ab",), ("abc",), ("abcd",), (None,)], "c string")
    assert rows(Fl.filter_length(df, "c", 2, 3)) == [("ab",), ("abc",)]


def test_has_digits_on_given_column(spark):
    df = spark.createDataFrame([("x1", "a"), ("xy", "b2")], "NodeID string, other string")
    assert rows(Fl.filter_has_digits(df, "other")) == [("xy", "b2")]
    assert rows(Fl.filter_has_digits(df)) == [("x1", "a")]


def test_null_handling(spark):
    df = spark.createDataFrame([(1, None, "en"), (None, None, "fr"), (3, 4, None)], "a int, b int, l string")
    assert rows(Fl.dropna(df, how="all", subset=["a", "b"])) == [(1, None, "en"), (3, 4, None)]
    assert rows(Fl.dropna(df, thresh=2)) == [(1, None, "en"), (3, 4, None)]
    assert rows(Fl.fillna(df, {"a": 0, "b": -1})) == [(0, -1, "fr"), (1, -1, "en"), (3, 4, None)]
    assert rows(Fl.replace_values(df, {"en": "english"}, subset=["l"]).select("l")) == [("english",), ("fr",), (None,)]
    assert rows(Fl.replace_values(df, "fr", None, subset=["l"]).select("l")) == [("en",), (None,), (None,)]


def test_dedup_subset_is_deterministic(spark):
    df = spark.createDataFrame([(1, "x", 3), (1, "x", 1), (1, "y", 2), (2, "x", 5)], "k int, s string, n int")
    assert rows(Fl.drop_duplicates(df, ["k", "s"], order_by=["n"])) == [(1, "x", 1), (1, "y", 2), (2, "x", 5)]
    assert rows(Fl.drop_duplicates(df, ["k"], order_by=["n"], keep="last")) == [(1, "x", 3), (2, "x", 5)]
    assert Fl.drop_duplicates(df, ["k"]).columns == ["k", "s", "n"]
    assert Fl.drop_duplicates(df.union(df)).count() == 4


def test_latest_window_and_range(spark):
    base = dt.datetime(2024, 1, 1, 12)
    data = [(i, base + dt.timedelta(hours=i)) for i in range(10)]
    df = spark.createDataFrame(data, "i int, ts timestamp_ntz")
    assert rows(Fl.latest_window(df, "ts", hours=4).select("i")) == [(6,), (7,), (8,), (9,)]
    got = Fl.time_range(df, "ts", F.lit(base + dt.timedelta(hours=2)), F.lit(base + dt.timedelta(hours=4)))
    assert rows(got.select("i")) == [(3,), (4,)]


def test_peek_and_sample_keys(spark):
    df = spark.createDataFrame([(k, v) for k in range(5) for v in range(3)], "k int, v int")
    assert rows(Fl.sample_keys(df, "k", 2).select("k").distinct()) == [(0,), (1,)]
    assert Fl.sample_keys(df, "k", 2).count() == 6
    assert [tuple(r) for r in Fl.peek(df, 2, order_by=[F.col("k").desc(), "v"]).collect()] == [(4, 0), (4, 1)]


def test_show_prints_first_rows(spark, capsys):
    df = spark.createDataFrame([("x" * 30, i) for i in range(8)], "s string, i int")
    Fl.show(df, 2)
    out = capsys.readouterr().out
    assert out.count("|") > 0 and "only showing top 2 rows" in out
    assert "x" * 21 not in out  # values cut at 20 characters


def test_cache_marks_for_reuse(spark):
    from linkgraph.session import cache
    df = cache(spark.range(5))
    assert df.storageLevel.useMemory and df.storageLevel.useDisk
    assert df.count() == 5
    df.unpersist()
