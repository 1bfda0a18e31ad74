import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from linkgraph.functions import expressions as X
from linkgraph.operators import columns as C
from tests.conftest import rows


def test_use_cols_keeps_table_order_and_rejects_unknown(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    assert C.use_cols(df, ["z", "x"]).columns == ["x", "z"]
    with pytest.raises(ValueError):
        C.use_cols(df, ["x", "nope"])


def test_drop_cols_ignores_unknown(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert C.drop_cols(df, ["y", "nope"]).columns == ["x"]


def test_rename_chain_and_unknown(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    out = C.rename_cols(df, {"a": "x", "x": "y", "missing": "z"})
    assert out.columns == ["y", "b"]
    with pytest.raises(ValueError):
        C.rename_cols(df, [("a", "b")])


def test_literal_and_assign_fn(spark):
    df = spark.createDataFrame([(1, "ab", 2.5)], "k int, s string, v double")
    out = (df.transform(C.add_literal, "Label", "Player")
             .transform(C.assign_fn, "up", "upper", "s")
             .transform(C.assign_fn, "r", "round", ["v", 0])
             .transform(C.assign_fn, "p", "lpad", {"col": "s", "len": 4, "pad": "*"})
             .transform(C.assign_fn, "n", "char_length", "s"))
    r = out.first()
    assert (r.Label, r.up, r.r, r.p, r.n) == ("Player", "AB", 3.0, "**ab", 2)


def test_assign_fn_without_python_wrapper(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert C.assign_fn(df, "l", "len", "s").first().l == 3


def test_astype_bad_values_become_null(spark, ansi):
    df = spark.createDataFrame([("12", "x"), ("oops", "3.7")], "a string, b string")
    out = C.astype(df, "int", ["a", "b"])
    assert rows(out) == [(12, None), (None, 3)]


def test_drop_null_cols_threshold_and_empty(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b string, c string")
    assert C.drop_null_cols(df).columns == ["a", "c"]
    assert C.drop_null_cols(df, threshold=1).columns == ["a", "b"]
    empty = df.limit(0)
    assert C.drop_null_cols(empty).columns == ["a", "b", "c"]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(C.null_profile(df).first()) == (1, 2)


def _stored(tmp_path):
    """Two files of one table: columns in another order, the second without statistics."""
    a = pa.table({"id": pa.array([1, 2, 3], pa.int64()), "text": ["x", None, "z"], "none": pa.array([None] * 3, pa.string()),
                  "tags": pa.array([[1], None, []], pa.list_(pa.int64())), "at": pa.array([{"x": None}, None, {"x": 1}], pa.struct([("x", pa.int64())]))})
    pq.write_table(a, tmp_path / "1.parquet")
    pq.write_table(a.select(["at", "none", "text", "tags", "id"]), tmp_path / "2.parquet", write_statistics=False)
    return str(tmp_path)


def test_null_profile_by_column(spark, tmp_path):
    df = spark.read.parquet(_stored(tmp_path))
    want = {"id": 0, "text": 2, "none": 6, "tags": 2, "at": 2}
    assert C.null_profile(df).first().asDict() == C.null_profile(df, by_column=True).first().asDict() == want
    assert set(C.drop_null_cols(df, by_column=True).columns) == {"id", "text", "tags", "at"}
    assert C.drop_null_cols(df, threshold=2, by_column=True).columns == C.drop_null_cols(df, threshold=2).columns
    empty = df.limit(0)
    assert set(C.null_profile(empty, by_column=True).first()) == {0}
    assert C.drop_null_cols(empty, by_column=True).columns == df.columns


def test_footers_spare_columns_without_nulls(spark, tmp_path):
    rows = 5000
    full = pa.table({"id": pa.array(range(rows), pa.int64()), "gap": pa.array([None if i == 0 else i for i in range(rows)], pa.int64())})
    pq.write_table(full, tmp_path / "t.parquet", row_group_size=1000)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its plan hides the scans
    try:
        out = C.null_profile(spark.read.parquet(str(tmp_path)), by_column=True)
        assert tuple(out.collect()[0]) == (0, 1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    leaves = out._jdf.queryExecution().executedPlan().collectLeaves()
    read = [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())]
    assert read == [0, 1000]  # no row of `id`; of `gap` the one row group that holds a NULL


def test_order_node_ids_swaps_on_not_greater_or_null(spark):
    df = spark.createDataFrame(
        [("e1", 5, "five", 3, "three"), ("e2", 2, "two", 9, "nine"), ("e3", 4, "four", 4, "four'"),
         ("e4", None, "none", 1, "one")],
        "e string, id1 int, n1 string, id2 int, n2 string")
    out = C.order_node_ids(df, {"id1": "n1"}, {"id2": ["n2"]})
    assert out.columns == ["e", "id1", "id2", "n1", "n2"]
    assert rows(out) == [("e1", 5, 3, "five", "three"), ("e2", 9, 2, "nine", "two"),
                         ("e3", 4, 4, "four'", "four"), ("e4", 1, None, "one", "none")]


def test_concat_null_part_gives_null_and_long_separator(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    out = C.concat_cols(df, "EdgeID", ["k", "s"], "--")
    assert rows(out.select("EdgeID")) == [("1--a",), (None,)]
    assert rows(C.concat_cols(df, "E", ["k", "s"]).select("E")) == [("1a",), (None,)]


def test_lpad_pads_and_truncates(spark):
    df = spark.createDataFrame([(7,), (123456,)], "k int")
    assert rows(C.lpad_col(df, "p", "k", 4, "0").select("p")) == [("0007",), ("1234",)]


def test_clean_text_keeps_latin_hebrew_digits_space(spark):
    df = spark.createDataFrame([("Ab 1-2_é שלום!",)], "t string")
    assert C.clean_cols(df, ["t"]).first().t == "Ab 12 שלום"


def test_stringify_and_auto_stringify(spark):
    df = spark.createDataFrame([(["b", None, "a"], None, "[x, y]")],
                               "tags_set array<string>, other_att array<string>, done_att string")
    out = C.auto_stringify(df).first()
    assert out.tags_set == "[b,a]"
    assert out.other_att == "[]"
    assert out.done_att == "[x, y]"  # already text: left alone


def test_parse_dates_and_times(spark, ansi):
    df = spark.createDataFrame([("31/12/2020", "2020-01-02 03:04:05"), ("bad", "nope")], "d string, t string")
    out = C.to_date_cols(df, ["d"]).transform(C.to_timestamp_cols, ["t"], "yyyy-MM-dd HH:mm:ss", ntz=True)
    got = rows(out.select(F.col("d").cast("string"), F.col("t").cast("string")))
    assert got == [("2020-12-31", "2020-01-02 03:04:05"), (None, None)]
    ep = C.to_epoch_cols(df, ["t"], "yyyy-MM-dd HH:mm:ss")
    assert rows(ep.select("t")) == [(1577934245,), (None,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_parsing_does_not_depend_on_the_session_zone(spark, zone):
    import datetime
    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-07-01 12:00:00",), ("bad",), (None,)], "t string")
    fmt = "yyyy-MM-dd HH:mm:ss"
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = df.select(X.parse_timestamp("t", fmt, ntz=True).cast("string").alias("n"), X.epoch_seconds("t", fmt).alias("e")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = [int(datetime.datetime(*d, tzinfo=datetime.timezone.utc).timestamp()) for d in [(2024, 3, 10, 2, 30), (2024, 7, 1, 12)]]
    assert [r.e for r in got] == [*want, None, None]
    assert [r.n for r in got] == ["2024-03-10 02:30:00", "2024-07-01 12:00:00", None, None]


def test_only_functions_are_called_by_name(spark):
    for name in ("udf", "Column", "overload", "sys"):
        with pytest.raises(Exception):
            spark.range(1).select(X.call_function(name, ["id"])).collect()
