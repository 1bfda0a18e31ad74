"""Filter interaction audit: what every filter removes, under every order of the filters.

Spark reduces the documents to counts by (part, mask), the mask telling which
filters a document fails.  Per part a Gray-code walk visits all subsets of filters
and toggles one at a time: every mask cell keeps the number of active filters that
it fails, and the running survivors change when that number leaves or reaches
zero.  The stored states, one for each subset, give every step of every order as a
difference of two states.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import WORD_RE

SPACE_RE = r"[\x20\x09-\x0D]+"
DUPLICATE = "E"

OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
       "toxic_lost long, shapley long")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text (null counts as empty), each true or false."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(body, SPACE_RE), lambda w: w != "")
    return {
        "A": F.regexp_count(body, F.lit(WORD_RE)) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(body, F.lit("[A-Z]")) > 10 * F.length(body),
        "D": body.rlike("[#$%&*|]"),
    }


def cells(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], text: str = "text", key: str = "doc_id",
          part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failed filters, and how many of them are labelled good or toxic.

    Bit i of the mask is the i-th of ``filters``; the last bit is the duplicate
    filter: a smaller id has the same text.  Rows are counted by (id, text) before
    they meet the labels, and by text with map-side sums after, so a group of
    copies is never gathered.

    * null part: the empty string, and one part with it.  Null text: empty.
    * null id: fails the duplicate filter where any id has the same text; has no label.
    * repeated rows count each; rows of one id with one text do not fail each other.
    * an id with several label rows is good, or toxic, if one of them says so.
    """
    mask = F.lit(0)
    for i, fails in enumerate(filters.values()):
        mask = mask + F.when(fails, F.lit(1 << i)).otherwise(F.lit(0))
    rows = (docs.select(docs[f"`{key}`"].cast("long").alias("id"), F.coalesce(docs[f"`{part}`"].cast("string"), F.lit("")).alias("part"),
                        F.sha2(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")), 256).alias("same"), mask.alias("mask"))
            .groupBy("id", "part", "same", "mask").agg(F.count("*").alias("c")))
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    no = F.lit(False)
    known = rows.where("id is not null").join(marks, F.col("id") == F.col("label_id"), "left").select(
        "id", "part", "same", "mask", "c", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    rows = known.unionByName(rows.where("id is null").select("*", no.alias("good"), no.alias("toxic")))
    # a text's rows now number its parts and labels at most, however many copies it has
    texts = (rows.groupBy("same", "part", "mask", "good", "toxic")
             .agg(F.sum("c").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "c"))).alias("least")))
    # rows of one id, part and text were counted together, so the least id's count is exact
    first = F.min("least.id").over(Window.partitionBy("same"))
    passing = (F.when(first.isNull(), F.col("n")).when(F.col("least.id") == first, F.col("least.c")).otherwise(F.lit(0)))
    texts = texts.withColumn("alone", passing)
    bit = F.lit(1 << len(filters))
    both = F.explode(F.array(F.struct(F.col("mask").alias("m"), F.col("alone").alias("k")),
                             F.struct((F.col("mask") + bit).alias("m"), (F.col("n") - F.col("alone")).alias("k"))))
    return (texts.select("part", "good", "toxic", both.alias("cell")).select("part", "good", "toxic", "cell.*")
            .groupBy("part", F.col("m").cast("int").alias("mask"))
            .agg(F.sum("k").alias("n"), F.sum(F.when(F.col("good"), F.col("k")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("k")).otherwise(0)).alias("toxic")))


def walk(counts: Mapping[int, tuple[int, ...]], k: int) -> list[tuple[int, ...]]:
    """Survivors under every subset of ``k`` filters: ``counts`` by mask of failed filters, the state of subset s at index s."""
    width = len(next(iter(counts.values()))) if counts else 1
    failing = dict.fromkeys(counts, 0)  # active filters that a cell fails
    alive = [sum(c[j] for c in counts.values()) for j in range(width)]
    states = [()] * (1 << k)
    subset = 0
    states[0] = tuple(alive)
    for step in range(1, 1 << k):
        bit = step & -step  # the Gray code toggles the lowest set bit of the step
        subset ^= bit
        way = 1 if subset & bit else -1
        for mask, c in counts.items():
            if mask & bit:
                was = failing[mask]
                failing[mask] = was + way
                if was == 0 or failing[mask] == 0:
                    alive = [a - way * x for a, x in zip(alive, c, strict=True)]
        states[subset] = tuple(alive)
    return states


def steps(counts: Mapping[int, tuple[int, int, int]], names: str) -> Iterator[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part."""
    k = len(names)
    states = walk(counts, k)
    everything = (1 << k) - 1
    fails = [sum(c[0] for m, c in counts.items() if m >> i & 1) for i in range(k)]
    unique = [states[everything ^ 1 << i][0] - states[everything][0] for i in range(k)]
    shapley = [sum(factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) * (states[s][0] - states[s | 1 << i][0])
                   for s in range(1 << k) if not s >> i & 1) for i in range(k)]
    for order in permutations(range(k)):
        subset = 0
        for step, i in enumerate(order, 1):
            before, after = states[subset], states[subset | 1 << i]
            subset |= 1 << i
            removed, good, toxic = (b - a for b, a in zip(before, after, strict=True))
            yield "".join(names[j] for j in order), step, after[0], removed, fails[i] - removed, unique[i], good, toxic, shapley[i]


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step, with what the step's filter does there.

    The conventions are those of ``cells``; ties do not arise.  A part's cells
    number 32 at most.  An empty table has no part and gives no row.
    """
    filters = text_filters(docs[f"`{text}`"])
    names = "".join(filters) + DUPLICATE

    def run(part: tuple, found: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(found["mask"], found["n"], found["good"], found["toxic"], strict=True)}
        return pd.DataFrame([(part[0], *row) for row in steps(counts, names)], columns=[c.split()[0] for c in OUT.split(", ")])

    return cells(docs, labels, filters, text, key, part).groupBy("part").applyInPandas(run, OUT)


ORACLE = r"""
WITH flags AS (
  SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents d),
words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM flags),
least AS (SELECT t, min(doc_id) AS least FROM flags GROUP BY t),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
      (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END)
      + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
      + (CASE WHEN 100 * length(regexp_replace(words.t, '[^A-Z]', '', 'g')) > 10 * length(words.t) THEN 4 ELSE 0 END)
      + (CASE WHEN regexp_matches(words.t, '[#$%&*|]') THEN 8 ELSE 0 END)
      + (CASE WHEN words.doc_id > least OR (words.doc_id IS NULL AND least IS NOT NULL) THEN 16 ELSE 0 END) AS m
    FROM words JOIN least ON words.t = least.t LEFT JOIN marks ON words.doc_id = marks.doc_id)
  GROUP BY part, m),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, f.bit,
    coalesce((SELECT sum(bit) FROM letters x WHERE strpos(filter_order, x.letter) < step), 0) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s, letters f
  WHERE substr(filter_order, step, 1) = f.letter),
told AS (
  SELECT part, filter_order, step, any_value(bit) AS bit,
    sum(CASE WHEN m & (earlier | bit)::BIGINT = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN m & earlier::BIGINT = 0 AND m & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN m & earlier::BIGINT <> 0 AND m & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN m = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN m & earlier::BIGINT = 0 AND m & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN m & earlier::BIGINT = 0 AND m & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, (SELECT filter_order, step, bit, earlier::BIGINT AS earlier FROM steps)
  GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM told
"""
