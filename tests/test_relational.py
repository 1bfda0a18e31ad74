import pytest

from linkgraph.operators import relational as R
from tests.conftest import rows


@pytest.fixture()
def pair(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n")], "k int, x string")
    b = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, y string")
    return a, b


def test_join_matrix(pair):
    a, b = pair
    assert rows(R.join_df(a, b, "k", "inner")) == [(2, "b", "B")]
    assert rows(R.join_df(a, b, "k", "cross")) == [(2, "b", "B")]
    assert rows(R.join_df(a, b, "k", "left")) == [(1, "a", None), (2, "b", "B"), (None, "n", None)]
    assert len(rows(R.join_df(a, b, "k", "full"))) == 5
    assert rows(R.join_df(a, b, "k", "left_semi")) == [(2, "b")]
    assert rows(R.join_df(a, b, "k", "left_anti")) == [(1, "a"), (None, "n")]
    with pytest.raises(ValueError):
        R.join_df(a, b, "k", "sideways")


def test_union_by_name_sorted_missing_and_type_conflict(spark, ansi):
    a = spark.createDataFrame([(1, "x")], "id int, code string")
    b = spark.createDataFrame([(2.5, 7)], "id double, code int")
    out = R.union_by_name(a, b)
    assert out.columns == ["code", "id"]
    assert rows(out) == [("7", 2.5), ("x", 1.0)]
    c = spark.createDataFrame([("z",)], "zeta string")
    assert R.union_by_name(a, c).columns == ["code", "id", "zeta"]


def test_union_tagged_and_keys(spark):
    a = spark.createDataFrame([(1,)], "v int")
    b = spark.createDataFrame([(2,)], "v int")
    out = R.union_tagged([({"season": "s1", "comp": "c"}, a), ({"season": "s2", "comp": "c"}, b)])
    assert rows(out) == [("s1", "c", 1), ("s2", "c", 2)]
    k = spark.createDataFrame([("asset_a",), ("b",), ("",), (None,), ("asset_a",)], "k string")
    assert rows(R.distinct_keys(k, "k", "asset")) == [("asset_a",)]
    assert R.row_count(k).first().n_rows == 5
