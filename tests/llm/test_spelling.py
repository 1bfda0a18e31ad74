import random
import re
import zlib
from collections import Counter

import pytest

from linkgraph.llm import spelling as S
from tests.llm.cases import TEXTS, documents, empty


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def count(rows, spoil=97, least=5, often=3):
    n = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % spoil == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= often}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_force(n, ratio=2):
    out, form = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = [w, n[w], len(others), form[w], n[form[w]] if form[w] else None]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return sorted(map(tuple, out.values()))


@pytest.mark.parametrize("seed,least", [(0, 1), (1, 1), (2, 4), (3, 5), (4, 5)])
def test_variants_against_all_pairs(spark, seed, least):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(least, least + 4))) for _ in range(150)}
    words |= {"".join(rnd.choice("aaaab") for _ in range(rnd.randrange(9, 13))) for _ in range(60)}
    n = {w: rnd.choice([3, 4, 6, 8, 16, 33, 70, 200]) for w in words}
    got = S.variants(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute_force(n)


def test_counts_and_variants_of_documents(spark):
    rnd = random.Random(9)
    words = ["Strasse", "strasse", "straße", "CHÂTEAU", "château", "chateau", "house", "houses", "mouse", "tiny", "a1b2", "naïve", "naive"]
    rows = [(rnd.choice([i, i, None]), " ".join(rnd.choice(words) + rnd.choice(["", ",", "-", "9"]) for _ in range(150)), "en", "a")
            for i in range(150)]
    counts = S.word_counts(documents(spark, rows), spoil=97)
    want = count(rows)
    assert {r.word: r.n for r in counts.collect()} == want
    assert any(len(w) == 6 for w in want) and "tiny" not in want
    assert sorted(map(tuple, S.variants(counts).collect())) == brute_force(want)
    assert {r.word: r.n for r in S.word_counts(documents(spark, rows)).collect()} == count(rows, 1 << 40)


def test_runs_are_never_cut(monkeypatch):
    text = "Ab" * 50 + " " + "éa" * 9 + "1" + "x" * 40 + " end "
    want = [lower(r) for r in re.findall("[A-Za-zÀ-ÿ]+", text) if len(r) >= 4]
    for block in (1, 2, 3, 7, 50, 1000):
        monkeypatch.setattr(S, "BLOCK", block)
        assert [r for part in S.runs(text, 4) for r in part] == want
    assert list(S.runs("", 4)) == []


def test_awkward_rows(spark):
    rows = TEXTS * 3
    got = S.variants(S.word_counts(documents(spark, rows), spoil=97))
    assert sorted(map(tuple, got.collect())) == brute_force(count(rows))
    assert S.variants(S.word_counts(empty(spark))).count() == 0
    with pytest.raises(ValueError):
        S.variants(spark.createDataFrame([("a", 1)], "word string, n long"), ratio=1)
