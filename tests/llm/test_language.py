import random

from pyspark.sql import functions as F

from linkgraph.llm import language as L
from linkgraph.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm.cases import TEXTS, documents, empty


def test_held_out_accuracy_and_range(spark):
    docs = spark.read.parquet(SF_SMALL.replace("sf0.001", "sf0.01") + "/documents.parquet")
    got = Q.op4_language(spark, SF_SMALL.replace("sf0.001", "sf0.01")).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"), F.count("*")).first()
    assert r[0] >= 0.97 and 0 <= r[1] <= r[2] <= 1 and r[3] > 100


def _model(tables, langs=("p", "q"), floor=-50.0):
    import numpy as np
    every = np.arange(len(langs))
    return {"langs": list(langs), "floor": dict.fromkeys(range(5), floor),
            "tables": {k: {w: (every, np.array(x)) for w, x in tables.get(k, {}).items()} for k in range(5)}}


def test_word_first_then_longest_grams():
    model = _model({0: {"abc": [-1.0, -2.0]}, 1: {c: [-5.0, -6.0] for c in " abcd"}, 2: {" a": [-2.0, -9.0]}, 4: {"bcd ": [-1.5, -1.0]}})
    assert L.score_word("abc", model).tolist() == [-1.0, -2.0]
    assert L.score_word("abcd", model).tolist() == [-3.5, -10.0]  # " a" + "bcd "
    assert L.score_word("z", model).tolist() == [-60.0, -62.0]  # " " + unseen + " "
    assert L.predict("12 !", model, {}) == ("und", 0.0) and L.predict(None, model, {}) == ("und", 0.0)


def test_letterlike_numerals_are_no_letters(spark):
    model = _model({0: {"a": [-1.0, -2.0]}})
    for text in ("\u00b2\u00bd\u2460", "\u2167", "1\u00b2 _ \u0663", "\u3007"):
        assert L.predict(text, model, {}) == ("und", 0.0)
    texts = ["a\u00b2b", "x\u2167y_z", "\u00aa\u02b0 \u0414\u0430", "\u4e2d\u6587 \u0e01\u0e34", "O\u00b4K \u01c5", "caf\u0065\u0301 9a"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = rows.select("i", F.regexp_extract_all(F.lower("t"), F.lit(L.LETTERS_SQL), F.lit(0)).alias("w")).collect()
    assert {r.i: sorted(r.w) for r in found} == {i: sorted(L.words(t).elements()) for i, t in enumerate(texts)}


def test_counts_and_frequencies_against_brute_force(spark):
    import math
    import re
    from collections import Counter
    rnd = random.Random(4)
    vocab = ["der", "die", "das", "the", "of", "caf\u00e9", "na\u00efve", "x"]
    rows = [(i, " ".join(rnd.choice(vocab) + rnd.choice(["", ".", "7"]) for _ in range(30)), rnd.choice(["de", "en", None]), "a") for i in range(60)]
    want = {k: Counter() for k in range(5)}
    for _, t, lang, _ in rows:
        for w in re.findall("[a-z\u00e9\u00ef]+", t) if lang else []:
            want[0][lang, w] += 1
            for n in range(1, 5):
                want[n].update((lang, f" {w} "[i:i + n]) for i in range(len(w) + 3 - n))
    counts = L.train(documents(spark, rows))
    assert {(r.kind, r.lang, r.item): r.n for r in counts.collect()} == {(k, *x): n for k, c in want.items() for x, n in c.items()}
    model = L.load(counts)
    for k, c in want.items():
        total = {lang: sum(n for (x, _), n in c.items() if x == lang) for lang in ("de", "en")}
        for (lang, item), n in c.items():
            if n > 1:
                at, logs = model["tables"][k][item]
                assert abs(dict(zip(at.tolist(), logs.tolist(), strict=True))[model["langs"].index(lang)] - math.log(n / total[lang])) < 1e-12
        assert model["floor"][k] == math.log(0.5 / max(total.values()))


def test_many_languages_and_a_rare_one(spark):
    """No limit on languages; a rare language among many labelled rows of others is learned."""
    rnd = random.Random(2)
    words = {f"l{i:03d}": ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(12)] for i in range(300)}
    rows = [(i * 10 + j, " ".join(w), lang, "a") for i, (lang, w) in enumerate(words.items()) for j in range(2)]
    model = L.load(L.train(documents(spark, rows)))
    assert len(model["langs"]) == 300
    memo = {}
    assert all(L.predict(" ".join(w[:8]), model, memo)[0] == lang for lang, w in words.items())
    many = spark.range(40_000).selectExpr("id AS doc_id", "'the of and is' AS text", "'en' AS lang").unionByName(
        spark.createDataFrame([(10**6 + i, "kala vesi maja puu", "et") for i in range(5)], "doc_id long, text string, lang string"))
    model = L.load(L.train(many, sample_rows=400))
    assert model["langs"] == ["en", "et"] and L.predict("vesi maja", model, {})[0] == "et"
    learned = L.train(many, sample_rows=400).where("kind = 0 and item = 'the'").first().n
    assert 120 <= learned <= 280  # half of the bound


def test_model_ignores_held_out_labels_and_ids(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["der", "die", "das"] if i % 2 else ["the", "of", "and"]) for _ in range(20)),
             "de" if i % 2 else "en", "a") for i in range(80)]
    docs = documents(spark, rows)
    model = Q.language_model(docs)
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = Q.language_model(docs.withColumn("lang", F.when(out, "zz").otherwise(F.col("lang"))))
    assert model["langs"] == other["langs"] == ["de", "en"]
    plain = lambda m: {w: (i.tolist(), x.tolist()) for w, (i, x) in m["tables"][0].items()}
    assert plain(model) == plain(other)


def test_awkward_rows(spark):
    d = documents(spark)
    model = L.load(L.train(d))
    got = L.identify(d, model)
    assert got.count() == len(TEXTS) and set(got.columns) == set(d.columns) | {"lang_pred"}
    r = {x.doc_id: x for x in got.collect()}
    assert r[3].lang_pred == r[4].lang_pred == r[5].lang_pred == "und" and r[5].score == 0
    assert r[7].lang_pred == "fr" and r[1].lang_pred == "en" and r[1]["row"] == "x"
    none = L.load(L.train(empty(spark)))
    assert none["langs"] == [] and L.identify(d, none).where("lang_pred != 'und'").count() == 0
    assert L.identify(empty(spark), model).count() == 0
