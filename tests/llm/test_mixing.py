import random

import pytest
from pyspark.sql import functions as F

from linkgraph.llm import mixing as M
from tests.llm.cases import TEXTS, documents, empty


def water_fill(sizes, weights, limit):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= limit * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = limit * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_against_repeated_resharing(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}": rnd.choice([0, 5, 100, 10_000]) * rnd.randrange(1, 9) for i in range(rnd.randrange(1, 12))} | {None: 40}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.weighted_targets(df, (5, 2, 1)).collect()}
    want = water_fill(sizes, (5, 2, 1), 3.0)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_thresholds_against_a_sorted_run(spark):
    rnd = random.Random(5)
    rows = [(s, rnd.randrange(40), rnd.getrandbits(36)) for s in ["a", "b", None] for _ in range(300)] + [("c", 0, 5)]
    goals = [("a", 1000.0), ("b", 1.5), (None, 4000.0), ("c", 0.5)]
    got = {r.source: r for r in M.thresholds(spark.createDataFrame(rows, "source string, size long, h long"),
                                             spark.createDataFrame(goals, "source string, goal double")).collect()}
    for s, goal in goals:
        run = 0
        for h, n in sorted((h, n) for x, n, h in rows if x == s):
            if run + n > goal:
                break
            run += n
        taken = sum(n for x, n, h in rows if x == s and h < got[s].threshold)
        assert taken == run and abs(got[s].rest - (goal - run)) < 1e-9


def test_mix_comes_near_its_targets_and_repeats(spark):
    rnd = random.Random(6)
    rows = [(i, "w " * rnd.randrange(1, 60), "en", rnd.choice("aaaaaabbc")) for i in range(900)]
    d = documents(spark, rows)
    got = M.mix(d, (5, 2, 1)).collect()
    again = M.mix(d.repartition(3), (5, 2, 1)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    by = {}
    source = {i: s for i, _, _, s in rows}
    for r in got:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        t = by.setdefault(source[r.doc_id], [0, r.target, 0])
        t[0] += r.taken
        t[2] += r.size
    assert abs(sum(t[1] for t in by.values()) - sum(t[2] for t in by.values())) < 1e-6
    assert all(abs(t[0] - t[1]) <= 30 for t in by.values())
    out = M.mixed(d, (5, 2, 1))
    assert out.columns == d.columns
    assert dict(map(tuple, out.groupBy("doc_id").count().collect())) == {r.doc_id: r.copies for r in got if r.copies}


def test_smaller_goal_keeps_a_subset(spark):
    rows = [("a", 1 + i % 7, (i * 7919) % (1 << 36)) for i in range(500)]
    df = spark.createDataFrame(rows, "source string, size long, h long")
    cuts = [M.thresholds(df, spark.createDataFrame([("a", float(g))], "source string, goal double")).first().threshold
            for g in (100, 500, 1500)]
    assert cuts == sorted(cuts)


def test_awkward_rows(spark):
    d = documents(spark)
    got = M.mix(d, (5, 2, 1))
    assert got.count() == len(TEXTS)
    r = {x.doc_id: x for x in got.collect()}
    assert r[3].size == 0 and r[3].taken == 0 and r[5].size == 0 and r[4].size == 0
    assert M.mixed(d, (5, 2, 1)).columns == d.columns
    assert M.mix(empty(spark), (5, 2, 1)).count() == 0 and M.mixed(empty(spark), (5, 2, 1)).count() == 0
    assert got.groupBy().agg(F.max("copies")).first()[0] <= 3


def test_plan_has_no_python(spark):
    plan = M.mix(documents(spark), (5, 2, 1))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
