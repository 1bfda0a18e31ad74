import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from linkgraph.llm import quality as K
from tests.llm.cases import TEXTS, documents, empty


def brute_rules(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
            len(w) < 20 or 100 * len(again) > 30 * len(w))


def test_base_rules():
    rnd = random.Random(1)
    for _ in range(200):
        t = "".join(rnd.choice([rnd.choice("ab#*$é日\xa0"), " ", "\n", " a b c d e f g h i"]) for _ in range(rnd.randrange(120)))
        assert K.base_rules(t) == brute_rules(t)
    assert K.base_rules(None) == K.base_rules("") == (0, 0, 0, 0, 0, True)


def brute_model(texts):
    """Interpolated modified Kneser-Ney over character 5-grams, by dictionaries."""
    padded = ["\0" * 4 + " ".join(t.lower().split()) for t in texts]
    tables = {5: Counter(p[i:i + 5] for p in padded for i in range(len(p) - 4))}
    for k in range(4, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    probs = {}
    for k in range(1, 6):
        n = Counter(tables[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0
        d = []
        for i in (1, 2, 3):
            x = i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[1] else None
            d.append(x if x is not None and 0 < x < i else 0.5)
        ctx = defaultdict(list)
        for g, c in tables[k].items():
            ctx[g[:-1]].append(c)
        for g, c in tables[k].items():
            cs = ctx[g[:-1]]
            weight = sum(d[min(x, 3) - 1] for x in cs) / sum(cs)
            low = probs[g[1:]] if k > 1 else 1 / (len(tables[1]) + 1)
            probs[g] = (c - d[min(c, 3) - 1]) / sum(cs) + weight * low
    return {g: math.log(p) for g, p in probs.items() if len(g) == 5}, padded


@pytest.mark.parametrize("most", [K.HELD, 20])
def test_model_against_brute_force(spark, most):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["ab", "abc", "bca", "é", "ca b", "A"]) for _ in range(rnd.randrange(1, 30))) for _ in range(25)]
    d = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    want, padded = brute_model(texts)
    for r in K.judge(d, most=most).collect():
        p = padded[r.doc_id]
        logs = [want[p[i:i + 5]] for i in range(len(p) - 4)]
        assert abs(r.log_ppl + sum(logs) / len(logs)) < 1e-5
        assert abs(r.error - np.std(logs) / math.sqrt(len(logs))) < 1e-4


def test_band_keeps_ordinary_text_and_rejects_noise(spark):
    rnd = random.Random(4)
    words = ["the", "of", "river", "house", "walks", "green", "under", "light", "stone", "and"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(30, 200))), "en", "a") for i in range(120)]
    rows += [(500, " ".join("".join(rnd.choice("qxzjkvwy") for _ in range(7)) for _ in range(60)), "en", "a"), (501, "the of " * 5, "en", "a")]
    got = {r.doc_id: r for r in K.judge(documents(spark, rows)).collect()}
    assert not got[500].kept and not got[500].base_failed and got[501].base_failed and not got[501].kept
    assert all(got[i].kept for i in range(120) if not got[i].base_failed)


def test_awkward_rows(spark):
    d = documents(spark)
    got = K.judge(d).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        if r.doc_id is not None:
            t = next(t for i, t, *_ in TEXTS if i == r.doc_id)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(t)
    assert K.judge(empty(spark)).count() == 0


@pytest.mark.parametrize("most", [K.HELD, 3000])
def test_every_gram_counts_in_a_large_language(spark, most):
    rnd = random.Random(5)
    marks = "abcdefghijklmnopqrstuvwxyzäöüßéèàçñ0123456789"
    texts = ["".join(rnd.choices(marks, k=12_000)) for _ in range(40)] + ["the same words again " * 40] * 3
    d = documents(spark, [(i, t, "de", "a") for i, t in enumerate(texts)])
    want, padded = brute_model(texts)
    assert len(want) > 400_000
    got = K.judge(d, most=most).collect() if most != K.HELD else K.judge(d).collect()
    assert len(got) == len(texts)
    for r in got:
        p = padded[r.doc_id]
        logs = [want[p[i:i + 5]] for i in range(len(p) - 4)]
        assert abs(r.log_ppl + sum(logs) / len(logs)) < 1e-6
        assert abs(r.error - np.std(logs) / math.sqrt(len(logs))) < 1e-6


def test_many_languages_share_what_is_held(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(30)), f"l{i % 20}", "a") for i in range(60)]
    a, b = ({r.doc_id: r for r in K.judge(documents(spark, rows), most=m).collect()} for m in (K.HELD, 500))
    assert all(abs(a[i].log_ppl - b[i].log_ppl) < 1e-9 and a[i].kept == b[i].kept for i in a)
