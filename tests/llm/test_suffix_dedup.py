import hashlib
import random
from collections import Counter

import pytest

from tessera.llm import suffix_dedup as S


def brute(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(r), len(r) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé中") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (60, 100, 150, 400)]
    texts = [prose(rng.randint(1, 200)) for _ in range(25)]
    for _ in range(40):
        base = rng.choice(texts) if rng.random() < 0.5 else prose(rng.randint(0, 80))
        cut = rng.randint(0, len(base))
        texts.append(base[:cut] + rng.choice(["", word(), rng.choice(passages)]) + base[cut:])
    line = prose(12)
    texts += [None, "", "x" * 1500, "ab" * 900, (line + "\n") * 40, passages[3], passages[3][:-1]]
    return texts


@pytest.mark.parametrize("hot", [S.HOT, 1])
def test_matches_brute_force(spark, hot, monkeypatch):
    texts = corpus(3)
    monkeypatch.setattr(S, "COLLECTION", 7)
    monkeypatch.setattr(S.repeated_spans, "__defaults__", (*S.repeated_spans.__defaults__[:-1], hot))
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, k1 int, packed string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.repeat_report(docs).collect()}
    for i, expected in enumerate(brute(texts)):
        assert got[i] == expected, i


def test_repeated_and_null_ids(spark):
    long = corpus(4)[3] * 2
    long = (long * (1000 // len(long) + 1))[:1000]
    texts = [long, long, "z" + long[:300]]
    docs = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (5, texts[2])], "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.repeat_report(docs).collect())
    assert got == sorted(brute(texts))


def test_transform_orders_all_suffixes():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30))) for _ in range(20)]
    owner, offset = S.suffix_order(texts, 1)
    got = [texts[i][o:] for i, o in zip(owner, offset)]
    assert got == sorted(t[o:] for t in texts for o in range(len(t)))


def test_empty(spark):
    assert S.repeat_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def plain_words(texts, least=51):
    import re

    said = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + least]) for w in said for i in range(len(w) - least + 1))
    out = []
    for w in said:
        hit = set()
        for i in range(len(w) - least + 1):
            if seen[tuple(w[i : i + least])] > 1:
                hit |= set(range(i, i + least))
        out.append(len(hit))
    return out


def test_words_of_repeated_passages(spark):
    rng = random.Random(9)
    texts = corpus(5)
    short = " ".join(rng.choice("abcdef") for _ in range(55))
    for n in (50, 51, 55):
        part = " ".join(short.split()[:n])
        texts += [f"one {n} {part} x", f"{part}\tother {n}"]
    texts += ["a " * 60, " ".join(str(i) for i in range(51)), " ".join(str(i) for i in range(50)), " ".join(str(i) for i in range(52))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeated_words"] for r in S.remove_repeats(docs, least_words=S.LEAST_WORDS).collect()}
    expected = plain_words(texts)
    assert sum(n > 0 for n in expected) > 10 and 0 in expected
    assert [got[i] for i in range(len(texts))] == expected


def test_one_passage_in_very_many_texts(spark):
    """A hot anchor: hundreds of different texts round one passage, and some that share more of it."""
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(90))
    texts = [f"{' '.join(word() for _ in range(rng.randint(0, 30)))} {passage[rng.randint(0, 30):len(passage) - rng.randint(0, 90)]} {' '.join(word() for _ in range(20))}" for _ in range(1300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.repeat_report(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
