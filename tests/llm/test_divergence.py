import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, least=30, k=50):
    groups, df, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = Counter(TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))
        groups[lang, source] += terms
        whole[lang] += terms
        df[lang].update(terms.keys())
    kept = {lang: [t for t in whole[lang] if df[lang][t] >= least] for lang in {g[0] for g in groups}}
    share = lambda counts, lang: {t: 1 + 10**9 * (counts[t] + 5) // (sum(counts[x] for x in kept[lang]) + 5 * len(kept[lang])) for t in kept[lang]}
    p = {g: share(counts, g[0]) for g, counts in groups.items()}
    q = {lang: share(whole[lang], lang) for lang in kept}
    out = []
    for lang, source in groups:
        own = p[lang, source]
        pairs = [(-sum(abs(own[t] - p[o][t]) for t in kept[lang]), o[1]) for o in groups if o[0] == lang and o[1] != source]
        terms = [(q[lang][t] - own[t], t) for t in kept[lang] if groups[lang, source][t] > 0 and own[t] > q[lang][t]]
        for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:k])):
            ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))
            out += [(lang, source, part, item, -value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def corpus(seed=11, n=500):
    rng = random.Random(seed)
    pool = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"] + ["é", "中文", "ÉTÉ", "straße", "\U0001f600", "｡"]
    docs = []
    for _ in range(n):
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", "é", "\U0001f600", "｡"])
        lang = rng.choice(["en", "en", "de", None])
        lean = pool[ord(source[0]) % 7 :: 3] if rng.random() < 0.5 else pool
        docs.append((lang, source, " ".join(rng.choice([w, w.upper()]) for w in rng.choices(lean, k=rng.randint(0, 40)))))
    docs += [("xx", "only", "few words here"), ("yy", "a", "nothing"), ("yy", "b", None), ("yy", None, ""), ("en", "silent", None), ("en", "digits", "1234 @@ \x00")]
    docs += [("en", "s2", "kk " * 50000 + "lone")] + [("de", "s9", "ak bl cm")] * 40
    return docs


def frame(spark, docs):
    return spark.createDataFrame(docs, "lang string, source string, text string").selectExpr("*", "'t' as term", "1 as n", "2 as i", "3 as v", "'p' as part")


def rows(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def test_equals_brute_force(spark):
    docs = corpus()
    assert rows(D.divergence_report(frame(spark, docs))) == brute(docs)


@pytest.mark.parametrize("k", [1, 7])
def test_small_chunks_blocks_and_bounds(spark, monkeypatch, k):
    """The same rows however terms, sources and counts are cut."""
    docs = corpus(12, 300)
    monkeypatch.setattr(D, "CHUNK_TERMS", 9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = rows(D.divergence_report(frame(spark, docs).repartition(5), least_documents=6, k=k))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(docs, 6, k)


def test_blocks_of_sources(spark):
    """More sources than a block holds: every pair once in each direction."""
    docs = [("en", f"s{i:03}", f"aa bb {'cc ' * (i % 5)}") for i in range(D.BLOCK_SOURCES + 9)]
    assert rows(D.divergence_report(frame(spark, docs))) == brute(docs)


def test_empty_table(spark):
    assert rows(D.divergence_report(frame(spark, corpus()).limit(0))) == []


def test_counts_in_a_task_stay_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(D, "_HELD_ROWS", 20)
    rng = random.Random(1)
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"] * 5, "source": [rng.choice("ab") for _ in range(5)], "text": [" ".join(rng.choice("vwxyz") * rng.randint(1, 9) for _ in range(12)) for _ in range(5)]}) for _ in range(30)]
    n, df = Counter(), Counter()
    for b in D._task_counts(iter(batches)):
        for r in b.to_pylist():
            n[r["source"], r["term"]] += r["n"]
            df[r["source"], r["term"]] += r["df"]
    want_n, want_df = Counter(), Counter()
    for b in batches:
        for r in b.to_pylist():
            terms = [(r["source"], t) for t in r["text"].split()]
            want_n.update(terms)
            want_df.update(set(terms))
    assert n == want_n and df == want_df


def test_skyband_equals_counting_all_pairs():
    rng = np.random.default_rng(4)
    for size in (0, 1, 40, 1500):
        n, total, rank = rng.integers(0, 30, size), rng.integers(0, 30, size), rng.permutation(size)
        better = (n[:, None] >= n) & (total[:, None] <= total) & (rank[:, None] <= rank)
        for k in (1, 3, 50):
            assert sorted(D.skyband(n, total, rank, k).tolist()) == np.flatnonzero(better.sum(axis=0) - 1 < k).tolist()
