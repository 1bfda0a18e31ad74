"""Quality rules and n-gram perplexity.

The language model is a modified Kneser-Ney model over 5-grams of characters, one
per language, counted by Spark over all documents.  A character is a symbol of 12
bits, so an n-gram is a whole number: dropping its first or last character is a
shift or a mask, and contexts and lower orders are found by joins on such numbers.
Workers hold the n-grams seen most often as sorted arrays of these numbers beside
log-probabilities and look them up by binary search; all others are looked up in
the stored table by a join, so every n-gram of every document gets its own
probability.  Documents whose perplexity lies outside their language's band are
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import small_batches, split_largest, stash

ORDER, BITS = 5, 12
#: Code points from here on share the symbols above it by their remainder.
FOLD = 3840
#: Most n-grams that workers hold at once, over all languages; the others are joined, so this changes no result.
HELD = 2_000_000
#: A task hands its counts on when it holds so many different n-grams.
FLUSH = 2_000_000
#: Characters scored at once.
CHUNK = 1_000_000
#: A band reaches so many interquartile ranges beyond the quartiles of log-perplexity.
BAND = 3.0
#: A document also has to be outside by so many standard errors of its own mean, so that short texts are not rejected by chance.
ERRORS = 2.0
MIN_WORDS, WINDOW, MAX_REPEAT_PCT = 20, 8, 30
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"


def base_rules(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of a text; null counts as empty."""
    text = text or ""
    words = text.encode().split()  # bytes: ASCII white space only
    n = len(words)
    repeat = 0
    if n > WINDOW:
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        m = n - WINDOW + 1
        runs = np.zeros(m, np.uint64)
        for i in range(WINDOW):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + h[i:i + m]
        _, where, count = np.unique(runs, return_inverse=True, return_counts=True)
        edge = np.zeros(n + 1, np.int64)
        again = np.flatnonzero(count[where] > 1)
        edge[again] += 1
        edge[again + WINDOW] -= 1
        repeat = int((np.cumsum(edge[:n]) > 0).sum())
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeat, n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All 5-grams of texts as numbers, and how many each text has; one for each character.

    White space runs count as one space, letters as lower case; a text begins with four symbols 0.
    """
    plain = [" ".join(t.lower().split()) for t in texts]
    pad = "\0" * (ORDER - 1)
    code = np.frombuffer((pad + pad.join(plain)).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    code = np.where(code < FOLD, code, FOLD + code % ((1 << BITS) - FOLD))
    n = len(code) - ORDER + 1
    keys = np.zeros(max(n, 0), np.uint64)
    for i in range(ORDER):
        keys = (keys << np.uint64(BITS)) | code[i:i + n]
    size = np.array([len(p) for p in plain], np.int64)
    # windows that end in the padding of the next text are no n-grams
    begin = np.concatenate(([0], np.cumsum(size[:-1] + ORDER - 1))) if len(size) else size
    keep = np.zeros(len(keys) + 1, np.int64)
    np.add.at(keep, begin, 1)
    np.add.at(keep, begin + size, -1)
    return keys[np.cumsum(keep[:-1]) > 0].astype(np.int64), size


def _slices(texts: list[str]) -> Iterator[list[int]]:
    """Consecutive positions of texts with about CHUNK characters in all."""
    part, n = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        n += len(t)
        if n >= CHUNK:
            yield part
            part, n = [], 0
    if part:
        yield part


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, key, n): counts of all 5-grams of all texts per language; null language is the empty string."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, (k, n) in held.items():
                for i in range(0, len(k), 1 << 17):
                    part = k[i:i + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(part),
                                                      pa.array(n[i:i + (1 << 17)])], names=["lang", "key", "n"])
            held.clear()

        for b in batches:
            by: dict[str, list[str]] = {}
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t:
                    by.setdefault(name or "", []).append(t)
            for name, texts in by.items():
                for part in _slices(texts):
                    keys, _ = grams([texts[i] for i in part])
                    k, n = np.unique(keys, return_counts=True)
                    if name in held:
                        k = np.concatenate([held[name][0], k])
                        n = np.concatenate([held[name][1], n])
                        k, at = np.unique(k, return_inverse=True)
                        n = np.bincount(at, weights=n).astype(np.int64)
                    held[name] = (k, n)
                    if sum(len(x) for x, _ in held.values()) > FLUSH:
                        yield from out()
        yield from out()

    rows = docs.select(docs[f"`{lang}`"].cast("string").alias("lang"), docs[f"`{text}`"].cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _mask(k: int) -> int:
    return (1 << BITS * k) - 1


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): modified Kneser-Ney discounts of one order from its counts of counts."""
    c = counts.groupBy("lang").agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)],
                                   F.count("*").alias("types"))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    d = [F.when((F.col(f"n{i}") > 0) & (F.col("n1") > 0), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))
         for i in (1, 2, 3)]
    # too few counts, or a discount out of range: half a count
    return c.select(F.col("lang").alias("l2"), "types", *[
        F.when((x > 0) & (x < i), x).otherwise(0.5).alias(f"d{i}") for i, x in zip((1, 2, 3), d, strict=True)])


def kneser_ney(counts: DataFrame) -> dict[int, DataFrame]:
    """Interpolated probabilities of all n-grams by order: (lang, key, n, logp).

    Orders under the highest count in how many n-grams one
    character longer theirs ends.
    """
    tables = {ORDER: stash(counts, "kn-counts")}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = stash(tables[k + 1].groupBy("lang", F.col("key").bitwiseAND(F.lit(_mask(k))).alias("key"))
                          .agg(F.count("*").alias("n")), "kn-counts")
    probs: dict[int, DataFrame] = {}
    for k in range(1, ORDER + 1):
        t = tables[k]
        d = stash(discounts(t), "kn-discounts")  # one row per language
        ctx = F.shiftright("key", BITS).alias("ctx")
        sums = (t.groupBy("lang", ctx).agg(F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("a1"),
                                           F.count_if(F.col("n") == 2).alias("a2"), F.count_if(F.col("n") > 2).alias("a3"))
                .join(d, F.col("lang") == F.col("l2")))
        weight = (F.col("d1") * F.col("a1") + F.col("d2") * F.col("a2") + F.col("d3") * F.col("a3")) / F.col("total")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        sums = stash(sums.select(F.col("lang").alias("l3"), F.col("ctx"), "total", weight.alias("weight"), "types",
                                 "d1", "d2", "d3"), "kn-contexts")
        p = t.withColumn("c", F.shiftright("key", BITS)).join(sums, (F.col("lang") == F.col("l3")) & (F.col("c") == F.col("ctx")))
        if k == 1:
            low = 1 / (F.col("types") + 1)
        else:
            below = probs[k - 1].select(F.col("lang").alias("l4"), F.col("key").alias("suffix"), F.exp("logp").alias("low"))
            p = p.join(below, (F.col("lang") == F.col("l4")) & (F.col("key").bitwiseAND(F.lit(_mask(k - 1))) == F.col("suffix")))
            low = F.col("low")
        probs[k] = stash(p.select("lang", "key", "n", F.log((F.col("n") - cut) / F.col("total") + F.col("weight") * low)
                                  .alias("logp")), "kn-probs")
    return probs


def _find(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, values) of keys in a sorted array."""
    if table is None or not len(table[0]):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return table[0][at] == keys, table[1][at]


def hold(table: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """{language: (keys, logps)} of a bounded table (lang, key, logp), sorted by key."""
    got = table.select("lang", "key", "logp").toArrow().combine_chunks()
    if not got.num_rows:
        return {}
    names = got.column("lang").combine_chunks().dictionary_encode()
    at, key, logp = names.indices.to_numpy(), got.column("key").to_numpy(), got.column("logp").to_numpy()
    order = np.lexsort((key, at))
    edge = np.searchsorted(at[order], np.arange(len(names.dictionary) + 1))
    return {lang: (key[order[i:j]], logp[order[i:j]])
            for lang, i, j in zip(names.dictionary.to_pylist(), edge[:-1], edge[1:], strict=True)}


def measure_own(docs: DataFrame, probs: DataFrame, text: str = "text", lang: str = "lang", most: int = HELD) -> DataFrame:
    """The base rules' numbers, log_ppl and its standard error (null without characters) of every row of ``docs``; without the text.

    ``probs`` holds the probabilities of all 5-grams of these documents.

    Workers look up the at most ``most`` n-grams seen most often.  The distinct
    other ones of each document are joined with the rest of ``probs``.  Those that
    occur in very many documents are held, so no key of that join is hot.
    """
    spark = docs.sparkSession
    small_batches(spark)
    often, rest = split_largest(probs, most)
    shared = spark.sparkContext.broadcast(hold(often))  # bounded by most
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                  "base_failed boolean, size long, total double, square double, missed array<long>, times array<long>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, langs in batches:
            texts, langs = [t or "" for t in texts], [x or "" for x in langs]
            sizes, sums = np.zeros(len(texts), np.int64), np.zeros((2, len(texts)))
            missed, times = [None] * len(texts), [None] * len(texts)
            by: dict[str, list[int]] = {}
            for i, x in enumerate(langs):
                by.setdefault(x, []).append(i)
            for x, rows in by.items():
                for part in _slices([texts[i] for i in rows]):
                    at = [rows[i] for i in part]
                    keys, size = grams([texts[i] for i in at])
                    found, logs = _find(shared.value.get(x), keys)
                    logs = np.where(found, logs, 0.0)
                    ends = np.cumsum(size)
                    sizes[at] = size
                    for k, v in enumerate((logs, logs * logs)):
                        c = np.concatenate(([0.0], np.cumsum(v)))
                        sums[k, at] = c[ends] - c[ends - size]
                    for i, begin, end in zip(at, ends - size, ends, strict=True):
                        own = ~found[begin:end]
                        if own.any():
                            missed[i], times[i] = np.unique(keys[begin:end][own], return_counts=True)
            out = pd.DataFrame([base_rules(t) for t in texts], columns=names)
            yield out.assign(size=sizes, total=sums[0], square=sums[1], missed=pd.Series(missed, dtype=object),
                             times=pd.Series(times, dtype=object))

    kept = [c for c in docs.columns if c not in (*names, text)]
    out = docs.select(*[docs[f"`{c}`"] for c in kept], F.monotonically_increasing_id().alias("_row"),
                      run(docs[f"`{text}`"].cast("string"), docs[f"`{lang}`"].cast("string")).alias("_m"))
    # the numbers of the rows are fixed by writing them
    rows = stash(out.select(*[f"`{c}`" for c in kept], "_row", "_m.*"), "quality-rows")
    far = (rows.where(F.col("missed").isNotNull())
           .select("_row", F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("l5"),
                   F.explode(F.arrays_zip("missed", "times")).alias("g"))
           .select("_row", "l5", F.col("g.missed").alias("k5"), F.col("g.times").alias("times")))
    more = (far.join(rest, (F.col("l5") == F.col("lang")) & (F.col("k5") == F.col("key")))
            .groupBy(F.col("_row").alias("_row2"))
            .agg(F.sum(F.col("times") * F.col("logp")).alias("more"),
                 F.sum(F.col("times") * F.col("logp") * F.col("logp")).alias("more2")))
    some = F.when(F.col("size") > 0, F.col("size"))
    mean = (F.col("total") + F.coalesce("more", F.lit(0.0))) / some
    spread = (F.col("square") + F.coalesce("more2", F.lit(0.0))) / some - mean * mean
    joined = rows.join(more, F.col("_row") == F.col("_row2"), "left")
    return joined.select(*[f"`{c}`" for c in kept], *names, (-mean).alias("log_ppl"),
                         F.sqrt(F.when(spread > 0, spread).when(some.isNotNull(), 0.0) / some).alias("error"))


def bands(measured: DataFrame, lang: str = "lang", width: float = BAND) -> DataFrame:
    """(band_lang, lower, upper): per language the log-perplexities of ordinary documents (those the base rules pass).

    The quartiles, widened by ``width`` interquartile ranges.
    """
    q = F.percentile_approx("log_ppl", [0.25, 0.75], 10_000)
    return (measured.where(~F.col("base_failed")).groupBy(F.coalesce(F.col(lang), F.lit("")).alias("band_lang"))
            .agg(q.alias("q")).select("band_lang", (F.col("q")[0] - width * (F.col("q")[1] - F.col("q")[0])).alias("lower"),
                                      (F.col("q")[1] + width * (F.col("q")[1] - F.col("q")[0])).alias("upper")))


def in_band(errors: float = ERRORS) -> Column:
    """Whether log_ppl lies in its band, give or take ``errors`` standard errors; false where there is none."""
    slack = errors * F.col("error")
    return F.coalesce(F.col("log_ppl").between(F.col("lower") - slack, F.col("upper") + slack), F.lit(False))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = HELD) -> DataFrame:
    """(key, lang, base numbers, base_failed, log_ppl, error, lower, upper, kept) for every row of ``docs``.

    * null text counts as empty: no words, base_failed.
    * null language has a model and a band of its own.
    * every n-gram counts with its own probability, however many there are; ``most`` bounds only what workers hold at once.
    * ties do not matter; repeated rows get the same verdict.  An empty table gives an empty result.
    """
    rows = docs.select(docs[f"`{key}`"].alias(key), docs[f"`{text}`"].alias("text"), docs[f"`{lang}`"].alias("lang"))
    probs = kneser_ney(count_grams(rows))
    measured = stash(measure_own(rows, probs[ORDER], most=most), "quality")
    limits = stash(bands(measured), "quality-bands")
    return (measured.join(limits, F.coalesce("lang", F.lit("")) == F.col("band_lang"), "left")
            .withColumn("kept", ~F.col("base_failed") & in_band()).drop("band_lang"))
