import math
import random
import re
from collections import Counter

import numpy as np

from tessera.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, bag, sum(bag.values())) for d, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for d, bag, n in bags:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in terms(text) if t in bag)
            if score > 0:
                scored.append((-score, d is None, d if d is not None else 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed=13, n=400):
    rng = random.Random(seed)
    common = ["The", "of", "und", "9", "中文", "é", "x"]
    rare = [f"Term{i}" for i in range(150)]
    word = lambda: rng.choice(common) if rng.random() < 0.6 else rng.choice(rare)
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(n)]
    docs += [(5000 - i, "term1 term2; TERM3") for i in range(50)]
    docs += [(None, "term1 term2 term3"), (7000, None), (7001, ""), (7002, "-- ;"), (3, "the of term9"), (3, "the of term9"), (7003, "term5 " * 30000)]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 25)))) for i in range(20)]
    items += [(50, "term1 term2 term3"), (51, None), (52, "--"), (53, "nowhere"), (54, "the the THE of"), (50, "term7"), (None, "term9 term9 x")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as id", "'n' as n", "'t' as terms", "'s' as score", "'i' as item_id")
    return d, spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "'i' as i", "'d' as doc_id", "7 as rank")


def test_equals_brute_force(spark):
    docs, items = corpus()
    got = S.search_report(*frames(spark, docs, items)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_slices_and_many_blocks(spark, monkeypatch):
    docs, items = corpus(14)
    monkeypatch.setattr(S, "SLICE_ITEMS", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        d, i = frames(spark, docs, items)
        got = S.search(d.repartition(3), i, k=5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=str) == brute(docs, items, 5)


def test_empty_tables(spark):
    docs, items = frames(spark, *corpus())
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id > 6999 and doc_id < 7003"), items)):
        got = S.search_report(a, b)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.collect() == []


def _block(rng, n_docs, n_terms, n_items, density):
    own = S._Slice([(i, Counter(rng.choices([f"t{j:03}" for j in range(n_terms)], k=rng.randint(1, 12)))) for i in range(n_items)])
    held = [sorted(j for j in range(len(own.terms)) if rng.random() < density / (1 + j % 9)) for _ in range(n_docs)]
    df = Counter(t for ts in held for t in ts)
    own.weigh(n_docs, sum(map(len, held)) + n_docs, dict(df))
    tfs = [rng.randint(1, 5) for ts in held for _ in ts]
    return own, S._Block.build(own, np.array([len(ts) + 1 for ts in held]), np.array([len(ts) for ts in held]), np.array([t for ts in held for t in ts], np.int64), np.array(tfs, np.int64))


def test_bounds_skip_and_lose_nothing():
    """Whatever the threshold, all documents that reach it are found; pair bounds score fewer than all."""
    rng = random.Random(5)
    fewer = 0
    for _ in range(40):
        n = rng.randint(1, 120)
        own, block = _block(rng, n, rng.randint(1, 60), 6, rng.choice([0.1, 0.4, 1.0]))
        for i, item in enumerate(own.items):
            scores = np.zeros(n, np.int64)
            for t, times in item:
                docs, impacts = block.term(t)
                scores[docs] += times * impacts
            low = np.sort(block.seeds(i, n, 3))
            assert all(np.sort(scores)[::-1][j] >= low[::-1][j] for j in range(len(low)))
            for threshold in (0, 1, int(scores.max() // 2), int(np.median(scores)), int(scores.max()), int(scores.max()) + 1):
                docs, got, n_scored = block.best(i, n, threshold)
                assert docs.tolist() == np.flatnonzero((scores > 0) & (scores >= threshold)).tolist() and np.array_equal(got, scores[docs])
                fewer += n_scored < np.count_nonzero(scores)
    assert fewer > 200


def test_pair_bounds_are_tighter_than_single_bounds():
    own = S._Slice([(0, Counter({"a": 1, "b": 1}))])
    own.weigh(100, 1000, {0: 3, 1: 3})
    n = np.full(6, 10)
    block = S._Block.build(own, n, np.array([1, 1, 1, 1, 1, 1]), np.array([0, 1, 0, 1, 0, 1]), np.array([9, 9, 1, 1, 1, 1], np.int64))
    single = int(block.tops.sum())
    docs, _, scored = block.best(0, 6, int(block.tops.max()) + 1)
    assert single > block.tops.max() + 1 and not len(docs) and scored == 0
