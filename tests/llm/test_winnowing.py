import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from linkgraph.llm import winnowing as W
from tests.llm.cases import TEXTS, documents, empty


def brute(h, w):
    if not h:
        return []
    w = min(w, len(h))
    picked = set()
    for j in range(len(h) - w + 1):
        low = min(h[j:j + w])
        picked.add(max(i for i in range(j, j + w) if h[i] == low))
    return [(h[p], p) for p in sorted(picked)]


def test_chosen_hashes_against_brute_force(spark):
    rnd = random.Random(1)
    cases = [[rnd.randrange(6) for _ in range(rnd.randrange(15))] for _ in range(200)]
    df = spark.createDataFrame([(c,) for c in cases], "h array<bigint>")
    for w in (1, 4, 7):
        for r in df.select("h", W.chosen(F.col("h"), w).alias("c")).collect():
            assert [(x.hash, x.pos) for x in r.c] == brute(list(r.h), w)


def test_shared_run_gives_a_shared_hash(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    pairs = []
    for _ in range(40):
        shared = rnd.sample(words, W.K + W.W - 1)
        pairs.append(tuple(" ".join(rnd.choices(words, k=20) + shared + rnd.choices(words, k=20)) for _ in range(2)))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(W.hashes(W.fingerprint(F.col("a"))).alias("a"), W.hashes(W.fingerprint(F.col("b"))).alias("b"))
    assert all(set(r.a) & set(r.b) for r in got.collect())


def rolled(words, k):
    """The cyclic polynomial of every run, from the words' own hashes."""
    def rotate(x, n):
        return (x << n | x >> 64 - n) % (1 << 64) if n else x

    runs = [words[i:i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    out = []
    for run in runs:
        h = 0
        for w in run:
            h = rotate(h, 1) ^ xxhash.xxh64_intdigest(w.encode(), 42)
        out.append(h - (1 << 64) if h >> 63 else h)
    return out


def test_rolled_hashes_against_brute_force(spark):
    rnd = random.Random(5)
    cases = [[rnd.choice(["a", "bb", "é", "ccc"]) for _ in range(n)] for n in (0, 1, 2, 4, 5, 6, 9, 30)]
    df = spark.createDataFrame([(c,) for c in cases], "ws array<string>")
    for k in (1, 2, 3, 4, 5, 7, 8, 13):
        for r in df.select("ws", W.grams(F.col("ws"), k).alias("g")).collect():
            assert list(r.g) == rolled(list(r.ws), k)


def test_shared_run_without_spaces_gives_a_shared_hash(spark):
    rnd = random.Random(6)
    for alphabet in ([chr(0x4e00 + i) for i in range(400)], [chr(0xe01 + i) for i in range(40)]):
        pairs = []
        for _ in range(30):
            shared = "".join(rnd.choices(alphabet, k=W.K + W.W - 1))
            pairs.append(tuple("".join(rnd.choices(alphabet, k=rnd.randrange(40))) + shared + "".join(rnd.choices(alphabet, k=rnd.randrange(40)))
                               for _ in range(2)))
        df = spark.createDataFrame(pairs, "a string, b string")
        got = df.select(W.hashes(W.fingerprint(F.col("a"))).alias("a"), W.hashes(W.fingerprint(F.col("b"))).alias("b"))
        assert all(set(r.a) & set(r.b) for r in got.collect())


def test_next_document_and_edited_text(spark):
    rows = [(i, f"text number {i} " * (1 + i % 5), "en", "a") for i in range(60)]
    by = {i: t for i, t, *_ in rows}
    got = W.edited_comparison(documents(spark, rows)).collect()
    assert len(got) == 60
    for r in got:
        text, nxt = by[r.doc_id], by[(r.doc_id - 1) % 60]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.n_chars == len(text)
    same = W.with_next(documents(spark, rows).withColumn("tie", F.lit(0).cast("long")).select("doc_id", "tie", "text"), "doc_id",
                       "tie", ["text"], parts=7).collect()
    assert all(r.next.text == by[(r.doc_id - 1) % 60] for r in same)


def test_awkward_rows(spark):
    got = W.edited_comparison(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, r.fingerprint)
    assert prints[1] == prints[2] and prints[3] == prints[4] == prints[5]
    assert W.edited_comparison(empty(spark)).count() == 0
    one = W.edited_comparison(documents(spark, TEXTS[:1])).first()
    assert one.near_next == 1.0
    # the row after the last one with an id is the first without
    order = [t for i, t, *_ in sorted((x for x in TEXTS if x[0] is not None), key=lambda x: -x[0])]
    last = [r for r in got if r.doc_id == 1][0]
    texts = {None, "le chat est sur la table et le chien dort dans la maison"}
    half = len(order[-1]) // 2
    assert last.edited_sha256 in {hashlib.sha256((order[-1][:len(order[-1]) - half] + (t or "")[:half]).encode()).hexdigest() for t in texts}


def test_plan_has_no_python(spark):
    plan = W.edited_comparison(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
