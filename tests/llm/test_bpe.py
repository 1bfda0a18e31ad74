import hashlib
import random

import numpy as np
import pytest

from linkgraph.llm import bpe as B
from linkgraph.llm.queries import vocabulary
from tests.llm.cases import TEXTS, documents, empty

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def pair():
    return B.Tokenizer(vocabulary()), tokenizers.Tokenizer.from_file(vocabulary())


def cases():
    rnd = random.Random(1)
    some = ["", " ", "a", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "\n\n \t x", "it's  don't WE'LL", "日本語 😀👍🏽 é",
            "a" * 5000, "ab" * 3000 + " " * 300 + "!!!", "\x00\x01�​ x", "１２３ ½ ²", "<|endoftext|", "　a 　", "\x85x\x1cy"]
    return some + ["".join(rnd.choice("ab c'dstrelvm\n\t 1½é́日😀!?.<|>_-‍\x1c") for _ in range(rnd.randrange(60))) for _ in range(400)]


def test_ids_and_text_as_the_library(pair, spark):
    own, ref = pair
    texts = cases() + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for t in texts:
        ids = own.encode(t)
        assert ids == ref.encode(t, add_special_tokens=False).ids
        assert own.decode(ids) == ref.decode(ids, skip_special_tokens=False)


def test_decoding_of_any_ids(pair):
    own, ref = pair
    rnd = random.Random(2)
    for _ in range(500):
        ids = [rnd.randrange(50257) for _ in range(rnd.randrange(9))]
        assert own.decode(ids) == ref.decode(ids, skip_special_tokens=False)


def test_merge_is_leftmost_lowest_rank(pair):
    own, _ = pair
    rnd = random.Random(3)
    for n in (2, 3, 16, 17, 18, 40, 300, 1000):
        start = [own.byte_id[rnd.choice(b"theanrio ")] for _ in range(n)]
        ids = list(start)
        while True:
            ranked = [(own.rank[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in own.rank]
            if not ranked:
                break
            r, i = min(ranked)
            ids[i:i + 2] = [own.made[r]]
        assert own.merge(list(start)) == ids


def test_awkward_rows(spark, pair):
    d = documents(spark)
    got = B.encode_documents(d, vocabulary(), ids=True)
    assert got.count() == len(TEXTS)
    by = {r.doc_id: r for r in got.collect()}
    for i, t, *_ in TEXTS:
        if i is not None:
            ids = pair[1].encode(t or "", add_special_tokens=False).ids
            assert by[i].ids == ids and by[i].n_tokens == len(ids)
            assert by[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert by[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert B.encode_documents(empty(spark), vocabulary()).count() == 0
