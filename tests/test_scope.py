"""Scoped scratch: stored tables and caches are given back at the end of a job, also after a failure."""

import os

import pytest
from pyspark.sql import functions as F

from linkgraph.plans import jobs as J
from linkgraph.session import cache, checkpoint_root, cut_lineage, scratch_scope
from linkgraph.sources import sinks as K
from tests.conftest import SF_SMALL, rows


def stored(spark):
    place = f"{checkpoint_root(spark)}/linkgraph".replace("file:", "")
    return set(os.listdir(place)) if os.path.isdir(place) else set()


def test_scope_deletes_what_was_stored_inside(spark):
    before = stored(spark)
    outside = cut_lineage(spark.range(5), "outside")
    with scratch_scope(spark) as scope:
        a = cut_lineage(spark.range(10).where("id > 3"), "inside")
        with scratch_scope(spark):
            cut_lineage(spark.range(3), "inner")
            assert len(stored(spark) - before) == 3
        assert len(stored(spark) - before) == 2 and a.count() == 6
        kept = scope.keep(a.where("id < 6"), "kept")
    assert {p.rsplit("-", 1)[0] for p in stored(spark) - before} == {"outside", "kept"}
    assert rows(kept) == [(4,), (5,)] and outside.count() == 5


def test_scope_shares_equal_plans(spark):
    before = stored(spark)
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    with scratch_scope(spark):
        a, b = (cut_lineage(li.where("l_quantity > 40").select("l_orderkey"), "same") for _ in range(2))
        other = cut_lineage(li.where("l_quantity > 41").select("l_orderkey"), "same")
        assert len(stored(spark) - before) == 2 and a is b and other.count() < a.count()
    assert stored(spark) == before


def test_scope_cleans_up_after_a_failure(spark):
    before = stored(spark)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        step = cache(cut_lineage(spark.range(10)).withColumn("x", F.col("id") * 2))
        assert step.count() == 10 and step.is_cached
        raise ZeroDivisionError
    assert stored(spark) == before and not step.is_cached


def test_whole_graph_export_leaves_no_scratch(spark, tmp_path, monkeypatch):
    before = stored(spark)
    names = ("lineitem", "orders", "supplier", "customer", "nation")
    tables = {n: spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in names}
    entries = J.export_whole_graph(tables, f"file://{tmp_path}/g")
    assert stored(spark) == before
    assert {e["name"] for e in entries} == {"supplies", "bought_with", "based_in", "Customer", "Nation", "Part", "Supplier"}
    assert all(K.read_export(spark, e).count() == e["row_count"] for e in entries)
    monkeypatch.setattr(K, "write_nodes", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        J.export_whole_graph(tables, f"file://{tmp_path}/h")
    assert stored(spark) == before and not (tmp_path / "h" / "import_manifest").exists()
