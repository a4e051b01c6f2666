import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tessera.llm import bpe


@pytest.fixture(scope="module")
def ours():
    return bpe.Encoder(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def theirs(ours):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def test_random_texts_equal_the_library(ours, theirs):
    rng = random.Random(1)
    pieces = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", " ", "a", "1", "!", "é", "中", "'s", "'re", "\t", "l", "r", "v", "e", "😀", "　", "<|endoftext|>"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(20000)]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text), repr(text)


def test_every_codepoint(ours, theirs):
    texts = [f"a{chr(c)}1" for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_long_pieces_and_a_full_cache(ours, theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    long = "ab1" * 3000 + "x" * 5000 + " " * 3000 + "é" * 400
    texts = [long, "one two three four five six seven", "", "one"]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_transitions_compose():
    """The scan over the monoid gives the states of a step-by-step run."""
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 11, 5000).astype(np.uint8)
    state, expected = bpe.FREE, []
    for k in kinds.tolist():
        state = bpe._step(state, k)
        expected.append(state)
    assert bpe._states(kinds).tolist() == expected


def test_tables(spark, theirs):
    rows = [(1, "Hello, world's  end\n"), (2, None), (3, ""), (1, "Hello, world's  end\n"), (None, "x" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as id", "2 as ids")
    digest = lambda t: hashlib.sha256(np.array(theirs.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest()
    got = sorted(map(tuple, bpe.round_trip(docs).collect()), key=str)
    assert got == sorted(((i, len(theirs.encode_ordinary(t or "")), digest(t), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)
    coded = bpe.encode(docs)
    assert sorted((r["bytes"].decode() for r in bpe.decode(coded).collect())) == sorted(t or "" for _, t in rows)
    for r in coded.where("doc_id = 1").collect():
        assert r["ends"][-1] == len(rows[0][1].encode()) and len(r["ends"]) == len(r["ids"])
    assert bpe.round_trip(docs.limit(0)).collect() == []
