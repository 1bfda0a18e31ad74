import subprocess
import sys
from collections import Counter

import corpus_pipeline as P
from linkgraph.llm import bpe, language, mixing, privacy
from linkgraph.llm import queries as Q
from linkgraph.llm.common import stash
from tests.llm.cases import TEXTS, documents, empty
from tests.llm.test_simhash import brute_fp, groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def staged(spark, docs):
    out = [docs]
    for _, f in P.STAGES:
        out.append(stash(f(spark, out[-1], None), "t"))
    return out


def test_stages_against_plain_python(spark):
    rows = [(i, f"the house of number {i % 25} and the river of stone {i % 25} " * (1 + i % 3) + f"mail m{i}@x.example.com", "en", f"s{i % 3}")
            for i in range(60)] + [(100, "12 34", "en", "s0"), (101, None, None, None)]
    docs = documents(spark, rows).select(*COLUMNS)
    one, two, three, four, five = staged(spark, docs)[1:]
    assert all(x.columns == COLUMNS for x in (one, two, three, four))
    model = Q.language_model(docs)
    want = [r for r in rows if language.predict(r[1], model, {})[0] != "und"]
    assert sorted(r.doc_id for r in one.collect()) == [r[0] for r in want]
    fps = {r[0]: brute_fp(r[1]) for r in want}
    comp = groups([(a, b) for a in fps for b in fps if (fps[a] ^ fps[b]).bit_count() <= 4])
    want = [r for r in want if comp[r[0]] == r[0]]
    assert sorted(r.doc_id for r in two.collect()) == [r[0] for r in want]
    p = privacy.Pseudonymizer(privacy.DEMO_KEY)
    text = {r[0]: p.text(r[1])[0] for r in want}
    assert {r.doc_id: r.text for r in three.collect()} == text
    copies = {r.doc_id: r.copies for r in mixing.mix(three, Q.MIX_WEIGHTS).collect()}
    assert Counter(r.doc_id for r in four.collect()) == Counter({k: n for k, n in copies.items() if n})
    t = bpe.Tokenizer(Q.vocabulary())
    assert sorted((r.doc_id, r.n_tokens) for r in five.collect()) == sorted(
        (r.doc_id, len(t.encode(r.text))) for r in four.collect())


def test_awkward_and_empty_tables(spark):
    first, *rest = staged(spark, documents(spark).select(*COLUMNS))
    assert first.count() == len(TEXTS) and rest[-1].count() > 0
    assert staged(spark, empty(spark).select(*COLUMNS))[-1].count() == 0


def test_nothing_else_imports_the_subpackage():
    code = ("import sys; sys.path.insert(0, '.'); import linkgraph.plans.workload, linkgraph.plans.jobs, linkgraph.sources, linkgraph.streaming;"
            "assert not any(m.startswith('linkgraph.llm') for m in sys.modules)")
    subprocess.run([sys.executable, "-c", code], check=True)
