"""Substring dedup over sliding sentence spans.

The unit is the sentence; one too long to serve as a unit is cut further, after
words, or characters where a script has no spaces, that have the smallest hash
around.  From every unit on, and up to every unit, runs the shortest span of
consecutive units with at least MIN_WORDS words; its hash goes into one global
table.  Wherever a span's hash occurs again, in a later document or further down
in the same one, its units are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import small_batches, stash

#: Words of a span at least.
MIN_WORDS = 25
#: Kinds of tokens: words, characters of unspaced scripts, characters of long runs.
WORD, SIGN, RUN = 0, 1, 2
#: What they count for, in sixths of a word; more characters than LONGEST without white space are a long run.
SIZES, LONGEST = np.array([6, 3, 1], np.int64), 40
#: Sentences of at least so many tokens are cut: after the smallest hash of every so many.
WINDOWS = (12, 24, 72)
#: Thai, Lao, Tibetan, Myanmar, Khmer, Kana, Han.
UNSPACED = [(0x0e00, 0x0fff), (0x1000, 0x109f), (0x1780, 0x17ff), (0x3040, 0x30ff), (0x3400, 0x4dbf), (0x4e00, 0x9fff),
            (0xf900, 0xfaff), (0x20000, 0x3ffff)]
#: A sentence ends behind a STOP; behind an ENDER, CLOSERS after it and white space; and at a line feed.
STOPS, ENDERS, CLOSERS = "。！？", ".!?…", "\"'”’)]"
#: Classes of code points: other, white space, unspaced script, stop; the last entry stands for all code points behind it.
OTHER, SPACE, UNIT, STOP = 0, 1, 2, 3
CLASS = np.zeros(0x40001, np.uint8)
CLASS[[c for c in range(0x3001) if chr(c).isspace()]] = SPACE
for _a, _b in UNSPACED:
    CLASS[_a:_b + 1] = UNIT
CLASS[[ord(c) for c in STOPS]] = STOP
#: Marks beside the class: closer, ender.
CLOSER, ENDER = 4, 8
CLASS[[ord(c) for c in CLOSERS]] |= CLOSER
CLASS[[ord(c) for c in ENDERS]] |= ENDER
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
#: Base of the rolling sums, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: A share of all spans from which a hash counts as hot; so at most that many are.
HOT = 10_000


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX[1]
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int, known: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """The first ``n`` powers of ``base`` modulo 2^64; a table of common length is kept."""
    got = known.get(base)
    if got is None or len(got) < n:
        step = np.full(max(n, 1 << 14), base, np.uint64)
        step[0] = 1
        got = np.multiply.accumulate(step)
        if n <= 1 << 17:
            known[base] = got
    return got[:n]


def _tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(end, kind, hash, whether a sentence ends behind it) of the tokens of a text, with trailing white space."""
    code = np.frombuffer(text.replace("İ", "i").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    marks = CLASS[np.minimum(code, len(CLASS) - 1)]
    cls = marks & 3
    solid = cls != SPACE
    first = solid.copy()
    first[1:] &= (cls[1:] != cls[:-1]) | (cls[1:] == UNIT)
    count = np.concatenate([[0], np.cumsum(solid)])
    starts = np.flatnonzero(first)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
    ends = np.append(starts[1:], n)
    long = count[ends] - count[starts] > LONGEST
    if long.any():  # each character of a long run is a token
        inside = np.zeros(n, bool)
        inside[starts[0]:] = np.repeat(long, np.diff(np.append(starts, n)))
        first |= inside & solid
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        kind = np.where(inside[starts], RUN, WORD)
    else:
        kind = np.zeros(len(starts), np.int64)
    kind[cls[starts] == UNIT] = SIGN
    stops = starts + count[ends] - count[starts]  # where white space begins
    char = _mixed((code.astype(np.uint64) + MIX[0]) * MIX[2])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(char * _powers(BASE, n))])
    h = _mixed((sums[stops] - sums[starts]) * _powers(INVERSE, n)[starts])
    behind = np.maximum.accumulate(np.where(marks & CLOSER, -1, np.arange(n)))[stops - 1]
    lines = np.concatenate([[0], np.cumsum(code == 10)])
    last = ((stops < ends) & (behind >= 0) & (marks[behind] & ENDER > 0)
            | (lines[ends] > lines[stops]) | (cls[starts] == STOP))
    return ends, kind, h, last


def _units(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(end of each unit as a token count, ends of tokens, their sizes, their hashes).

    Every window of a long sentence holds a cut that depends on the window alone, so a
    passage is cut alike wherever it stands, but for a window's length at its ends.
    """
    ends, kind, h, last = _tokens(text)
    n = len(ends)
    if not n:
        return ends, ends, ends, h
    last[:-1] |= kind[1:] != kind[:-1]
    last[-1] = True
    sentence = np.cumsum(last) - last
    rank, others = h, kind.any()
    if others:  # a character counts with the three behind it
        more = np.concatenate([h, np.zeros(3, np.uint64)])
        rank = np.where(kind == WORD, h, _mixed(sum(more[i:i + n] * x for i, x in enumerate(MIX))))
    for k, w in enumerate(WINDOWS):
        if n >= w and (k == WORD or others):
            whole = sentence[w - 1:] == sentence[:n - w + 1]
            if others:
                whole &= kind[:n - w + 1] == k
            at = np.flatnonzero(whole)
            if len(at):
                views = np.lib.stride_tricks.as_strided(rank, (n - w + 1, w), 2 * rank.strides)[at, ::-1]
                last[at + w - 1 - views.argmin(axis=1)] = True
    return np.flatnonzero(last) + 1, ends, SIZES[kind], h


def sentences(text: str) -> list[tuple[int, int]]:
    """(begin, end) of the units of a text, with trailing white space; they cover it without gaps."""
    units, ends, *_ = _units(text)
    if not len(units):
        return [(0, len(text))] if text else []
    stops = ends[units - 1].tolist()
    return list(zip([0, *stops[:-1]], stops, strict=True))


def span_table(text: str, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, begin, end) of all spans in order, begin and end counting units; case and white space do not matter.

    A span's hash is a rolling sum over its tokens: a difference of two prefix
    sums, shifted to the span's begin.
    """
    units, _, size, h = _units(text)
    none = np.zeros(0, np.int64)
    least, n = min_words * int(SIZES[WORD]), len(units)
    if not n or size.sum() < least:
        return np.zeros(0, np.uint64), none, none
    upto = np.concatenate([[0], np.cumsum(size)[units - 1]])
    tokens = np.concatenate([[0], units])
    there = np.arange(n + 1)
    stop = np.searchsorted(upto, upto + least)  # from every unit on
    begin = np.searchsorted(upto, upto - least, "right") - 1  # up to every unit
    code = np.unique(np.concatenate([(there * (n + 1) + stop)[stop <= n], (begin * (n + 1) + there)[begin >= 0]]))
    i, j = np.divmod(code, n + 1)
    a, b = tokens[i], tokens[j]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(BASE, len(h)))])
    return _mixed((sums[b] - sums[a]) * _powers(INVERSE, len(h) + 1)[a] + (b - a).astype(np.uint64) * MIX[2]), i, j


def spans(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, int]]:
    """(hash, begin, end) of all spans, one by one."""
    return zip(*(x.tolist() for x in span_table(text, min_words)), strict=True)


def cut(text: str, covered: list) -> tuple[str, int]:
    """The text without the units in the given spans, and how many were removed."""
    units = sentences(text)
    edge = np.zeros(len(units) + 1, np.int64)
    for i, j in covered:
        edge[i] += 1
        edge[j] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return "".join(text[i:j] for (i, j), g in zip(units, gone, strict=True) if not g), int(gone.sum())


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(row, doc, body): doc orders documents; rows with null keys come last, each a document of its own.

    Numbers of rows with null keys are stored, so that a task that runs again finds the same ones.
    """
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    known = docs.select(row, docs[f"`{key}`"].cast("long").alias("doc"), docs[f"`{text}`"].cast("string").alias("body"))
    lost = known.where("doc is null").select("row", (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("doc"), "body")
    return known.where("doc is not null").unionByName(stash(lost, "spans-null-keys"))


def repeated_spans(keyed: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, hashes): of each document the hashes of spans that an earlier one has; an empty list for repeats of its own.

    Hashes are stored without positions and reduced to their smallest and largest
    document before they are shuffled.  The repeated ones are joined back: the hot
    ones, HOT at most at any size, by broadcast, all others by hash.
    """
    small_batches(keyed.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, docs, again = [np.zeros(0, np.uint64)], [], []
            for doc, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                h = span_table(body or "", min_words)[0]
                own = np.unique(h)
                hs.append(own)
                docs.append((doc, len(own)))
                again.append(len(own) < len(h))
            ids, counts = np.array([d for d, _ in docs], np.int64), np.array([n for _, n in docs], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.repeat(ids, counts)), pa.array(np.repeat(np.array(again, bool), counts))],
                names=["h", "doc", "again"])

    table = stash(keyed.select("doc", "body").mapInArrow(run, "h long, doc long, again boolean"), "spans")
    repeated = stash(table.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"))
                     .where("first < last").select(F.col("h").alias("h2"), "first", "n"), "spans-repeated")
    least = max(1, table.count() // HOT)
    is_hot: Column = F.col("n") > least
    later = [table.join(side, (F.col("h") == F.col("h2")) & (F.col("doc") > F.col("first"))).select("doc", "h")
             for side in (repeated.where(~is_hot), F.broadcast(repeated.where(is_hot)))]
    own = table.where("again").select("doc", F.lit(None).cast("long").alias("h")).distinct()
    return later[0].union(later[1]).union(own).groupBy("doc").agg(F.collect_set("h").alias("hashes"))


def without(text: str, hashes: list[int], min_words: int = MIN_WORDS) -> tuple[str, int]:
    """The text without its spans of the given hashes (signed) and without those it has itself further up."""
    h, i, j = span_table(text, min_words)
    h = h.view(np.int64)
    gone = np.ones(len(h), bool)
    gone[np.unique(h, return_index=True)[1]] = False
    gone |= np.isin(h, np.array(hashes, np.int64))
    return cut(text, list(zip(i[gone].tolist(), j[gone].tolist(), strict=True)))


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with repeated spans removed from ``text``; n_removed counts the units.

    * of equal spans the one in the smallest key stays, in one document the first one.
    * null text stays null, empty text empty; a text may become empty, its row stays.
    * rows with null keys come after all others, in the order they are read; each is a document of its own.
    * rows of one key count as one document, so they do not repeat each other; each row's own
      text is cut.  An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("text string, n int")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in batches:
            yield pd.DataFrame([(None, 0) if c is None or t is None else without(t, list(c), min_words)
                                for t, c in zip(texts, lists, strict=True)], columns=["text", "n"])

    keyed = _keyed(docs, text, key)
    covered = repeated_spans(keyed, min_words).select(F.col("doc").alias("doc2"), "hashes")
    joined = keyed.join(covered, F.col("doc") == F.col("doc2"), "left")
    got = joined.select("row", "hashes", run(F.when(F.col("hashes").isNotNull(), F.col("body")), F.col("hashes")).alias("got"))
    body = F.col(f"row.`{text}`").cast("string")
    cols = [F.coalesce("got.text", body).alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns if c != "n_removed"]
    return got.select(*cols, F.coalesce("got.n", F.lit(0)).alias("n_removed"))
