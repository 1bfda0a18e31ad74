"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

The tree's leaves stand for the pairs of neighbouring symbols and hold rank and
position as one number; an inner node holds the smallest number of its sixteen
children.  The root is therefore the lowest rank at its leftmost position.  A
merge changes three leaves, and each change runs up the tree as far as it alters
a node.  The merge loop ends when the root holds no rank.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import small_batches

#: Fixed value: the pattern by which byte-level BPE vocabularies cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Most cut pieces whose ids a task remembers.
MEMO = 400_000
#: A leaf without a mergeable pair; children of an inner node.
NONE = 1 << 60
WIDE = 16


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow from code point 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    symbols = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [symbols[b] for b in range(256)]


class Tokenizer:
    """A byte-level BPE vocabulary (tokenizers JSON) with encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        self.prefix_space = bool(pre.get("add_prefix_space"))
        symbols = byte_symbols()
        of_symbol = {s: b for b, s in enumerate(symbols)}
        vocab = model["vocab"]
        self.byte_id = [vocab[s] for s in symbols]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # by rank
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = r
            self.made.append(vocab[a + b])
        self.bytes_of = {i: bytes(of_symbol[c] for c in s) for s, i in vocab.items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.bytes_of |= {i: s.encode() for s, i in special.items()}
        self.cut = regex.compile(PATTERN)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merges the ids of one piece until no pair of neighbours has a rank."""
        n = len(ids)
        if n < 2:
            return ids
        rank, made = self.rank.get, self.made
        leaves = [NONE if (r := rank(p)) is None else r * n + i for i, p in enumerate(zip(ids, ids[1:], strict=False))]
        levels = [leaves]
        while len(levels[-1]) > WIDE:
            low = levels[-1]
            levels.append([min(low[j:j + WIDE]) for j in range(0, len(low), WIDE)])
        top, tall = levels[-1], len(levels) > 1
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while (key := min(top)) < NONE:
            r, left = divmod(key, n)
            right = after[left]
            nxt, prev = after[right], before[left]
            ids[left] = new = made[r]
            ids[right] = -1
            after[left] = nxt
            leaves[left] = NONE
            if nxt < n:
                leaves[right] = NONE
                before[nxt] = left
                if (got := rank((new, ids[nxt]))) is not None:
                    leaves[left] = got * n + left
            if prev >= 0:
                got = rank((ids[prev], new))
                leaves[prev] = NONE if got is None else got * n + prev
            if tall:
                for i in (left, right, prev):
                    if 0 <= i < n - 1:
                        for low, high in zip(levels, levels[1:], strict=False):
                            i //= WIDE
                            least = min(low[i * WIDE:i * WIDE + WIDE])
                            if high[i] == least:
                                break
                            high[i] = least
        return [i for i in ids if i >= 0]

    def piece(self, s: str) -> tuple[int, ...]:
        byte_id = self.byte_id
        ids = tuple(self.merge([byte_id[b] for b in s.encode()]))
        if len(s) <= 64:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[s] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the special tokens' strings in it count as special tokens, no others are added."""
        out: list[int] = []
        memo = self.memo
        for k, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if k % 2:
                out.append(self.special[part])
                continue
            if self.prefix_space and part and not part[0].isspace():
                part = " " + part
            for s in self.cut.findall(part):
                ids = memo.get(s)
                out.extend(self.piece(s) if ids is None else ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids; special tokens give their string, bytes that are no UTF-8 the replacement character."""
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in ids]).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", ids: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with n_tokens, ids_sha256 and decoded_sha256 added (replaced, if there).

    ``vocabulary`` is the path of a tokenizers JSON file that every executor can
    open.  ``ids=True`` adds the ids themselves (array<int>).  ids_sha256 is over
    the ids as little-endian unsigned 32-bit integers, decoded_sha256 over the
    decoded text in UTF-8.

    * null text: encoded as the empty text, no tokens.
    * a piece of any length is merged in n log n steps; a task remembers short pieces.
    """
    small_batches(docs.sparkSession)
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")

    @F.pandas_udf(fields)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = Tokenizer(vocabulary)
        for texts in batches:
            rows = []
            for s in texts:
                got = t.encode(s or "")
                row = [len(got), hashlib.sha256(np.array(got, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(t.decode(got).encode()).hexdigest()]
                rows.append([*row, got] if ids else row)
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    names = [f.split()[0] for f in fields.split(", ")]
    kept = [c for c in docs.columns if c not in names]
    out = docs.select(*[docs[f"`{c}`"] for c in kept], run(docs[f"`{text}`"].cast("string")).alias("_tokens"))
    return out.select(*[f"`{c}`" for c in kept], *[f"_tokens.{c}" for c in names])
