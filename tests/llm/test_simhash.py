import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.components import connected_components


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, f"{prints[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def near_texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 120))] for _ in range(n // 8)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    return rows


def test_matches_brute_force(spark):
    rows = near_texts(400, 1) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "Ünïcode Éa b"), (1004, "one two"), (7, "one two"), (None, "one two"), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("component", F.lit("x"))
    got = sorted(map(tuple, simhash.near_duplicate_report(docs).collect()), key=str)
    assert got == brute(rows)


def test_hot_buckets_are_cut_and_lose_nothing(spark):
    rng = random.Random(5)
    # values that differ in few low bits: they share buckets of most tables
    values = list({rng.getrandbits(9) for _ in range(300)} | {rng.getrandbits(63) for _ in range(50)})
    table = spark.createDataFrame([(v,) for v in values], "fp long")
    members, _ = connected_components(simhash.near_links(table, bucket=8))
    got = {r["node"]: r["component"] for r in members.collect()}
    root = {v: v for v in values}
    for _ in values:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 3 and root[a] > root[b]:
                    root[a], changed = root[b], True
        if not changed:
            break
    assert {v: got.get(v, v) for v in values} == root


@pytest.mark.parametrize("bits", [list(range(64)), list(range(21, 64)) + list(range(21))])
def test_masks_cover_every_three_bits(bits):
    masks = simhash.covering_masks(3, bits)
    assert len(masks) == 15
    for a in range(64):
        for b in range(a):
            for c in range(0, b, 5):
                flipped = 1 << a | 1 << b | 1 << c
                assert any(flipped & m == 0 for m in masks)


def test_keep_one_keeps_columns_and_single_rows(spark):
    rows = [(5, "a b c d", "x"), (3, "a b c d", "y"), (9, "q r s t u v", "z"), (9, "q r s t u v", "z"), (None, "a b c d", "n"), (4, None, "e"), (2, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 2, 3, 9]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicate_report(docs).collect() == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (None, 3), (7, 7)], "a long, b long")
    members, _ = connected_components(links)
    got = {r["node"]: r["component"] for r in members.collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}
