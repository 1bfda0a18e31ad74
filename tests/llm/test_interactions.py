import random
import re
from itertools import permutations

import pytest

from linkgraph.llm import interactions as I
from tests.llm.cases import TEXTS, documents, empty

LABELS = "doc_id long, quality int, toxic int"


def failing(rows):
    """Failed filters of every row, one document at a time."""
    out = []
    for i, t, *_ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(words) < 100:
            f.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t):
            f.add("C")
        if any(c in "#$%&*|" for c in t):
            f.add("D")
        if any(j is not None and (i is None or j < i) and (u or "") == t for j, u, *_ in rows):
            f.add("E")
        out.append(f)
    return out


def brute_force(rows, labels):
    fails = failing(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = []
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        lines, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone, left = [d for d in left if x in d[1]], [d for d in left if x not in d[1]]
                total[x] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                              sum(f == {x} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x))
        out += [(*line[:-1], total[line[-1]]) for line in lines]
    return sorted(out)


def random_rows(seed, n=60):
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "d#lta", "eps|lon", "zeta", "été", *[f"w{i}" for i in range(120)]]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([3, 99, 100, 130, 200]))) for _ in range(n // 3)]
    texts += ["word " * 100, " ".join(f"u{i}" for i in range(150))]
    rows = [(rnd.choice([i, i, i, None, 7]), rnd.choice(texts), rnd.choice(["en", "fr", None, ""]), "a") for i in range(n)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, n, 2)] + [(7, 1, 1), (None, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("seed", range(3))
def test_audit_against_removal_document_by_document(spark, seed):
    rows, labels = random_rows(seed)
    got = I.audit(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute_force(rows, labels)


def test_walk_toggles_one_filter_at_a_time():
    rnd = random.Random(3)
    counts = {m: (rnd.randrange(50), rnd.randrange(9)) for m in rnd.sample(range(32), 20)}
    states = I.walk(counts, 5)
    for s in range(32):
        assert states[s] == tuple(sum(c[j] for m, c in counts.items() if not m & s) for j in (0, 1))
    assert I.walk({}, 2) == [(0,)] * 4


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (99, 1, 1)], LABELS)
    got = sorted(map(tuple, I.audit(documents(spark), labels).collect()))
    assert got == brute_force(TEXTS, [(1, 1, 0), (2, 0, 1), (2, 1, 0), (99, 1, 1)])
    assert len(got) == 600 * 3
    assert I.audit(empty(spark), labels).count() == 0
    assert I.audit(documents(spark), labels.where("false")).count() == 1800
