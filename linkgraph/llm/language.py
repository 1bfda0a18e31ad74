"""Language identification by word-first backoff.

The model holds, per language, log frequencies of words and of character n-grams
of 1 to 4 characters inside words.  A known word scores its log frequency in
every language; an unseen word is covered from left to right by the longest
n-grams the model knows, and scores theirs.  A text's language is the one with
the largest sum; its score is that language's posterior probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import largest, small_batches, stash

#: The model learns from about this many labelled documents (all of them, if there are fewer), in equal shares for all
#: languages, so that a rare one is learned whatever the size of the table; chosen by a hash of the id.
SAMPLE_ROWS = 40_000
#: Most words, and most n-grams of each length, of a language in the model: those seen most often.
MAX_ITEMS = 20_000
LONGEST = 4
#: Most scores (words times languages) that a task remembers, and words whose scores are added up at once.
MEMO, BLOCK = 200_000, 4096
UNKNOWN = "und"
#: A run of letters in SQL; ``words`` finds the same runs in Python.
LETTERS_SQL = r"\p{L}+"
ALNUM = re.compile(r"[^\W\d_]+")


def words(text: str) -> Counter[str]:
    """Runs of letters of the lower-cased text, as ``LETTERS_SQL`` finds them; letter-like numerals are no letters."""
    found = Counter(ALNUM.findall(text.lower()))
    for w in [w for w in found if not w.isalpha()]:
        n = found.pop(w)
        for part in "".join(c if c.isalpha() else " " for c in w).split():
            found[part] += n
    return found


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(kind, lang, item, n): word counts (kind 0) and character n-gram counts (kind 1 to LONGEST), per language.

    The rows to learn from are a bounded sample by the hash of the key, with a
    threshold for each language.  Rows with null language or text are left out.
    """
    rows = (labelled.select(labelled[f"`{lang}`"].alias("lang"), labelled[f"`{text}`"].alias("text"),
                            F.shiftrightunsigned(F.xxhash64(labelled[f"`{key}`"]), 1).alias("h"))
            .where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.lit(float(sample_rows)) / F.count("*").over(Window.partitionBy())  # over the list of languages
    part = sizes.select(F.col("lang").alias("l2"), F.least(share / F.col("n"), F.lit(1.0)).alias("part"))
    # one row per language, as the model itself has; texts are not dealt by language
    rows = rows.join(F.broadcast(part), F.col("lang") == F.col("l2")).where(F.col("h") * F.lit(2.0 ** -63) < F.col("part")).select("lang", "text")
    words = (rows.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS_SQL), F.lit(0))).alias("item"))
             .groupBy("lang", "item").agg(F.count("*").alias("n")))
    words = stash(words, "lang-words")
    padded = F.concat(F.lit(" "), F.col("item"), F.lit(" "))
    grams = words.select("lang", "n", padded.alias("w"), F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("kind"))
    grams = (grams.where(F.length("w") >= F.col("kind"))
             .select("lang", "n", "kind", F.explode(F.transform(
                 F.sequence(F.lit(1), F.length("w") - F.col("kind") + 1),
                 lambda i: F.substring(F.col("w"), i, F.col("kind")))).alias("item"))
             .groupBy("kind", "lang", "item").agg(F.sum("n").alias("n")))
    return words.select(F.lit(0).alias("kind"), "lang", "item", "n").unionByName(grams)


def load(counts: DataFrame, max_items: int = MAX_ITEMS) -> dict:
    """The model as lookup tables: of each language the most frequent words and n-grams.

    An item holds its log frequencies in the languages that have it, so the size is
    bounded by the item limit times the number of languages, which is not limited.
    Items seen once are left to shorter n-grams; totals count all.
    """
    counts = stash(counts, "lang-counts")
    total = {(r["lang"], r["kind"]): r["n"] for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(lang for lang, kind in total if kind == 0)
    top = (largest(counts.where(F.col("n") > 1), ["lang", "kind"], max_items)
           .select("lang", "kind", "item", "n").toArrow().to_pydict())
    best: dict[int, dict[str, list[tuple[int, int]]]] = {k: {} for k in range(LONGEST + 1)}
    at = {lang: i for i, lang in enumerate(langs)}
    for lang, kind, item, n in zip(top["lang"], top["kind"], top["item"], top["n"], strict=True):
        best[kind].setdefault(item, []).append((at[lang], n))
    # log frequency; what a language lacks counts as half an occurrence in the language with most, for all alike
    most = {k: max([total.get((lang, k), 0) for lang in langs], default=0) for k in best}
    floor = {k: math.log(0.5 / max(most[k], 1)) for k in best}
    tables = {k: {item: (np.array([i for i, _ in has], np.int32), np.array([math.log(c / total[langs[i], k]) for i, c in has]))
                  for item, has in ((item, sorted(has)) for item, has in best[k].items())} for k in best}
    return {"langs": langs, "tables": tables, "floor": floor}


def score_word(word: str, model: dict) -> np.ndarray:
    """Log score of a lower-case word in every language: as a word, else by its longest known n-grams."""
    tables, floor, width = model["tables"], model["floor"], len(model["langs"])
    known = tables[0].get(word)
    if known is not None:
        if len(known[0]) == width:
            return known[1]
        out = np.full(width, floor[0])
        out[known[0]] = known[1]
        return out
    w = f" {word} "
    total, i, rest = np.zeros(width), 0, 0.0
    while i < len(w):
        for n in range(min(LONGEST, len(w) - i), 0, -1):
            got = tables[n].get(w[i:i + n])
            if got is not None:
                break
        else:
            n, got = 1, None
        if got is not None and len(got[0]) == width:
            total += got[1]
        else:
            rest += floor[n]  # what all languages get that lack the item
            if got is not None:
                total[got[0]] += got[1] - floor[n]
        i += n
    return total + rest


def predict(text: str | None, model: dict, memo: dict) -> tuple[str, float]:
    """(language, posterior probability) of a text; ``und`` and 0 without letters or without a model."""
    found = words(text or "")
    if not found or not model["langs"]:
        return UNKNOWN, 0.0
    total = np.zeros(len(model["langs"]))
    rows, counts = [], []
    for w, n in found.items():
        s = memo.get(w)
        if s is None:
            if len(memo) * len(total) >= MEMO:
                memo.clear()
            s = memo[w] = score_word(w, model)
        rows.append(s)
        counts.append(n)
        if len(rows) == BLOCK:  # bounded memory for texts with very many words
            total += np.array(counts, float) @ np.array(rows)
            rows, counts = [], []
    if rows:
        total += np.array(counts, float) @ np.array(rows)
    best = int(total.argmax())
    p = np.exp(total - total[best])
    return model["langs"][best], float(1 / p.sum())


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (0 to 1) added (replaced, if there).

    Null text and texts without letters: ``und``, score 0.  Nothing but the text
    is looked at.  Ties go to the language that comes first by code point.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the model's item limit

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo: dict[str, np.ndarray] = {}
        for texts in batches:
            yield pd.DataFrame([predict(t, shared.value, memo) for t in texts], columns=["lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.select(*[docs[f"`{c}`"] for c in kept], run(docs[f"`{text}`"].cast("string")).alias("_language"))
    return out.select(*[f"`{c}`" for c in kept], "_language.lang_pred", "_language.score")
