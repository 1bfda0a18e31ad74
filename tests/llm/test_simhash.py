import random
import re

import numpy as np
import pytest
import xxhash

from linkgraph.llm import simhash as S
from linkgraph.llm.components import components
from tests.llm.cases import TEXTS, documents, empty


def brute_fp(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_fingerprints(spark):
    rnd = random.Random(1)
    texts = ["", " ", "A b", "a B c D", "É é  x\ty\x0bz w\xa0v q"] + [
        " ".join(rnd.choice(["Ab", "cd", "EF", "é"]) for _ in range(rnd.randrange(30))) for _ in range(60)]
    for t in texts:
        assert S.fingerprint(t) % (1 << 64) == brute_fp(t)
    assert S.fingerprint(None) == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(1000, 1100)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == groups([(a, b) for a, b in edges if a is not None and a != b])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("tile", [4, 4096])
def test_links_against_brute_force(spark, tile):
    rnd = random.Random(2)
    fps = {rnd.getrandbits(64) for _ in range(150)}
    for f in list(fps)[:60]:  # near ones, in both directions over the sign bit
        for n in range(1, 8):
            fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), n)))
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = S.links(df, tile=tile).collect()
    u = np.array(signed).view(np.uint64)
    want = [(signed[i], signed[j]) for i in range(len(u)) for j in range(i) if int(u[i] ^ u[j]).bit_count() <= S.RADIUS]
    assert all((a ^ b) % (1 << 64) and ((a ^ b) % (1 << 64)).bit_count() <= S.RADIUS for a, b in got)
    assert groups([tuple(r) for r in got]) == groups(want)


def test_component_is_smallest_id(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(1000)}" for _ in range(400)]
    rows = [(50 - i, " ".join(base[:-1] + [f"end{i}"]), "en", "a") for i in range(12)]
    rows += [(100 + i, " ".join(f"u{rnd.randrange(10**6)}" for _ in range(50)), "en", "a") for i in range(12)]
    got = {r.doc_id: r for r in S.near_duplicates(documents(spark, rows)).collect()}
    fps = {i: brute_fp(t) for i, t, *_ in rows}
    want = groups([(a, b) for a in fps for b in fps if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {i: r.component_id for i, r in got.items()} == want
    kept = S.drop_near_duplicates(documents(spark, rows))
    assert {r.doc_id for r in kept.collect()} == set(want.values())
    assert kept.columns == documents(spark, rows).columns


def test_awkward_rows(spark):
    d = documents(spark)
    got = S.near_duplicates(d).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == 1 and by[3].fp == by[4].fp == by[5].fp == 0 and by[5].component_id == 3
    kept = S.drop_near_duplicates(d)
    roots = [r.root for r in got]
    assert kept.count() == len(set(roots))
    assert sum(r.doc_id == 1 for r in kept.collect()) == 1
    assert S.near_duplicates(empty(spark)).count() == 0 and S.drop_near_duplicates(empty(spark)).count() == 0
