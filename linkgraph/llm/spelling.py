"""Spelling variants: words that differ by one code point, found on a trie held as a table.

The trie's edge table has one row per (node, next character); a node is the hash
of a prefix, the word length and the direction of reading.  States (word,
position, node, edits) are joined with the edges level by level.  A pair of near
words agrees in the first or in the second half of the longer (or equally long)
word, so every word starts at the middle of its own path, where tries hardly
branch: once in a trie of words, once in a trie of reversed words.  From there a
state may replace the next character by a larger one, or skip it to end at a word
that is one shorter; both give each pair once, from one of its words.  A state
that reaches a branch with a single word ends by comparing the hash of the rest.
Every pair found is checked by its edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import small_batches, stash

#: Letters of a word: A-Z, a-z and the code points from U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
SEED = 42
#: One of so many (document, run) pairs has a code point removed, where asked for.
SPOIL = 97
#: Code points of a text that are searched at once, and distinct words that a worker holds before it hands them on.
BLOCK, HELD = 1 << 20, 1 << 17


def runs(text: str, least: int) -> Iterator[list[str]]:
    """Maximal letter runs of at least ``least`` code points with A-Z lower-cased, in lists of bounded length of text."""
    text = text.encode().lower().decode()  # bytes: A-Z only
    any_run, run = re.compile(f"[{LETTERS}]+"), re.compile(f"[{LETTERS}]{{{least},}}")
    i = 0
    while i < len(text):
        j = min(i + BLOCK, len(text))
        if j < len(text) and (m := any_run.match(text, j)):  # never cut inside a run
            j = m.end()
        yield run.findall(text, i, j)
        i = j


def spoiled(key: str, run: str, one_in: int) -> str:
    """``run``, without one of its code points if the pair's hash says so."""
    h = zlib.crc32(f"{key}:{run}".encode())
    if h % one_in:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, spoil: int | None = None) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points that occur at least ``min_count`` times.

    ``spoil`` removes a code point of every run in one of so many (document, run)
    pairs, chosen by a hash; a null id counts as an empty one there.  Workers add
    up what they read before it is shuffled.
    """
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for found in runs(t.as_py() or "", min_length):
                    if spoil is None:
                        held.update(found)
                        continue
                    for run, n in Counter(found).items():
                        if len(word := spoiled(k, run, spoil)) >= min_length:
                            held[word] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.coalesce(docs[f"`{key}`"].cast("string"), F.lit("")).alias("k"), docs[f"`{text}`"].cast("string").alias("t"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _node(way: Column, length: Column, prefix: Column) -> Column:
    """Hash of a trie node; ``_paths`` gives the same for every prefix of a word, in one pass over it."""
    return F.xxhash64(F.concat(way.cast("string"), F.lit(":"), length.cast("string"), F.lit(":"), prefix))


def _start(length: int, way: int) -> int:
    """Position from which a word may differ: its middle, but before its last two letters, where a shorter word would have ended."""
    half = length // 2
    return min(length - half if way else half, max(length - 2, 0))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, node, ch, child, rest, id): the steps of every word from its start on, forwards and backwards."""
    names = ["depth", "node", "ch", "child", "rest", "id"]
    types = [pa.int32(), pa.uint64(), pa.string(), pa.uint64(), pa.uint64(), pa.int64()]
    out: list[list] = [[] for _ in names]

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, t).view(pa.int64()) if t == pa.uint64() else pa.array(c, t) for c, t in zip(out, types, strict=True)]
        for c in out:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        for key, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for way, w in ((0, word), (1, word[::-1])):
                start = _start(len(w), way)
                ahead = xxhash.xxh64(f"{way}:{len(w)}:{w[:start]}".encode(), seed=SEED)
                after, rest = xxhash.xxh64(seed=SEED), []
                for ch in reversed(w[start:]):
                    rest.append(after.intdigest())
                    after.update(ch.encode())
                for depth in range(start, len(w)):
                    node = ahead.intdigest()
                    ahead.update(w[depth].encode())
                    for c, x in zip(out, (depth, node, w[depth], ahead.intdigest(), rest.pop(), key), strict=True):
                        c.append(x)
            if len(out[0]) > HELD:
                yield flush()
    yield flush()


def edges(words: DataFrame) -> DataFrame:
    """Trie edges from each word's start on, of (id, word): (depth, node, ch, child, under, rest, below).

    ``under`` counts the words below the edge; of a single one ``below`` is its id
    and ``rest`` the hash of what follows the edge, read backwards.  A shorter word
    starts no later than a longer one, so the paths that states can take are all there.
    """
    return (words.select("id", "word").mapInArrow(_paths, "depth int, node long, ch string, child long, rest long, id long")
            .groupBy("depth", "node", "ch").agg(F.min("child").alias("child"), F.count("*").alias("under"), F.min("rest").alias("rest"),
                                                F.min("id").alias("below")))


def starts(words: DataFrame) -> DataFrame:
    """First states, of (id, word): every word at its start, in the tries of its own length and of the next shorter one."""
    length = F.length("word")
    half = F.floor(length / 2).cast("int")
    latest = F.greatest(length - 2, F.lit(0))
    ways = F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("w"), F.least(half, latest).alias("depth")),
                   F.struct(F.lit(1).alias("way"), F.reverse("word").alias("w"), F.least(length - half, latest).alias("depth")))
    rows = words.select("id", F.explode(ways).alias("x"), length.alias("length")).select("id", "length", "x.*")
    return (rows.withColumn("shorter", F.explode(F.array(F.lit(0), F.lit(1))))
            .select("depth", "id", "w", "shorter", _node(F.col("way"), F.col("length") - F.col("shorter"), F.expr("substring(w, 1, depth)")).alias("node"),
                    F.lit(0).alias("edits")))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): ids of words that may differ by one code point, from (id, word) of distinct words.

    Each level joins the states at one depth with the edges there and is stored.
    Levels go on while two words share a path, so their number follows the longest
    common half of two words, not the number of words.
    """
    trie = stash(edges(words).sortWithinPartitions("depth"), "trie")
    # a state at depth d has read d characters of the trie, and one more of its word once it has skipped one
    states = stash(starts(words).sortWithinPartitions("depth"), "trie-starts")
    begin = sorted(r[0] for r in states.select("depth").distinct().collect())  # at most the number of word lengths
    found, carried, depth = [], None, None
    while begin or carried is not None:
        depth = begin[0] if carried is None else depth
        here = states.where(F.col("depth") == depth).drop("depth")
        begin = [d for d in begin if d > depth]
        here = here if carried is None else here.unionByName(carried)
        # skipping a character leaves the node as it is
        ways = F.when((F.col("shorter") == 1) & (F.col("edits") == 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array("edits"))
        here = here.withColumn("edits", F.explode(ways))
        position = F.lit(depth) + F.col("shorter") * F.col("edits")
        here = here.withColumn("own", F.substring("w", position + 1, F.lit(1)))
        step = trie.where(F.col("depth") == depth).select(F.col("node").alias("from"), "ch", "child", "under", "rest", "below")
        kept = (F.col("ch") == F.col("own")) | ((F.col("edits") == 0) & (F.col("shorter") == 0) & (F.col("ch") > F.col("own")))
        moved = here.join(step, (F.col("node") == F.col("from")) & kept)
        edited = F.when(F.col("ch") == F.col("own"), F.col("edits")).otherwise(F.lit(1))
        after = F.substring("w", position + 2, F.length("w"))
        # the end of a shorter word: the skipped character is the last one
        ends = (F.col("shorter") == 1) & (edited == 0) & (F.length("w") == depth + 2)
        equal = (edited == 1) & (F.xxhash64(F.reverse(after)) == F.col("rest"))
        hit = F.when((F.col("under") == 1) & (ends | equal), F.col("below"))
        go_on = ~ends & ((F.col("under") > 1) | ((F.col("shorter") == 1) & (edited == 0)))
        level = stash(moved.select("id", "w", "shorter", F.col("child").alias("node"), edited.alias("edits"), hit.alias("hit"), go_on.alias("on"))
                      .where("on or hit is not null"), "trie-level")
        found.append(level.where("hit is not null").select(F.col("id").alias("a"), F.col("hit").alias("b")))
        carried = level.where("on").drop("hit", "on")
        depth += 1
        if carried.isEmpty():
            carried = None
    if not found:
        return words.select(F.col("id").alias("a"), F.col("id").alias("b")).where("false")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.distinct()


def variants(words: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of (word, n).

    ``form`` is the near word with the largest n (ties: the smallest in code point
    order), if that is at least ``ratio`` times the word's own; ``root`` is where
    forms lead from the word, the word itself if it has none.  Near words differ by
    one inserted, deleted or replaced code point.

    * words must be distinct and not null; an empty table gives an empty result.
    * counts grow along forms, so that they never lead back (``ratio`` above 1).
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    words = stash(words.select(F.xxhash64("word").alias("id"), "word", "n"), "spelling-words")
    pairs = near_pairs(words.select("id", "word"))
    one = words.select(F.col("id").alias("a"), F.col("word").alias("wa"), F.col("n").alias("na"))
    two = words.select(F.col("id").alias("b"), F.col("word").alias("wb"), F.col("n").alias("nb"))
    pairs = stash(pairs.join(one, "a").join(two, "b").where(F.levenshtein("wa", "wb") == 1).select("wa", "na", "wb", "nb"), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("wb").alias("wa"), F.col("nb").alias("na"), F.col("wa").alias("wb"), F.col("na").alias("nb")))
    best = (both.groupBy("wa").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), "wb")).alias("best")))
    near = words.join(best, F.col("word") == F.col("wa"), "left")
    form = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.wb"))
    near = stash(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
                             F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), "spelling-near")
    roots = _roots(near.where("form is not null").select("word", F.col("form").alias("root")))
    return (near.join(roots.select(F.col("word").alias("w2"), "root"), F.col("word") == F.col("w2"), "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))


def _roots(step: DataFrame) -> DataFrame:
    """(word, root): where repeated steps lead.  Every round doubles the steps made, until none leads on."""
    while True:
        on = step.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = stash(step.join(on, F.col("root") == F.col("at"), "left")
                     .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        step = step.select("word", "root")
