import random
import re

from tessera.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = WORD.findall(lower(text or ""))
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = WORD.findall(lower(text or ""))
        hit, items = set(), set()
        for key, names in windows.items():
            for i in range(len(w) - len(key) + 1):
                if tuple(w[i : i + len(key)]) == key:
                    hit |= set(range(i, i + len(key)))
                    items |= names
        out.append((doc, len(w), len(hit), len(items), D.digest_sha(list(items)), bool(hit)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    word = lambda: rng.choice(["aa", "Bb", "cé", "D1", "中文", "x", "yy", "zz"])
    bench = [(i, " ".join(word() for _ in range(rng.choice([3, 9, 10, 14, 30])))) for i in range(25)] + [(100, None), (101, "--"), (102, "only")]
    docs = []
    for i in range(120):
        body = [word() for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            body.insert(rng.randint(0, len(body)), rng.choice(bench)[1] or "")
        docs.append((i, "; ".join(body)))
    return [*docs, (500, None), (501, ""), (502, "ONLY"), (502, "ONLY")], bench


def frames(spark, docs, bench):
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as id", "'s' as spans"), spark.createDataFrame(bench, "item_id long, text string")


def test_matches_brute_force(spark):
    docs, bench = corpus()
    got = D.contamination_report(*frames(spark, docs, bench)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, bench)


def test_slices_of_a_large_benchmark(spark):
    docs, bench = corpus()
    docs = docs[:-1]
    got = D.contamination_report(*frames(spark, docs, bench), slice_windows=40).collect()
    assert {r["doc_id"]: (r["n_items"], r["items_sha256"], r["contaminated"]) for r in got} == {r[0]: (r[3], r[4], r[5]) for r in brute(docs, bench)}


def test_slices_give_the_rows_of_one_slice(spark):
    docs, bench = corpus()
    long = " ".join(f"w{i}" for i in range(11))
    docs = [*docs, (600, f"see {long} there"), (600, f"{long}, {long}"), (600, "other words"), (None, long), (None, None), (None, f"no {long}")]
    bench = [*bench, (103, long)]
    df, b = frames(spark, docs, bench)
    got = D.contamination_report(df, b, slice_windows=40).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, bench)
    spans = lambda **options: sorted((str(r["doc_id"]), str(r["spans"])) for r in D.find_contamination(df, b, **options).collect())
    assert spans(slice_windows=40) == spans()


def test_neighbouring_windows_in_two_slices(spark):
    long = " ".join(f"w{i}" for i in range(11))
    docs, bench = [(1, f"see {long} there"), (1, f"{long}, {long}"), (None, long), (None, None)], [(1, long)]
    got = D.contamination_report(*frames(spark, docs, bench), slice_windows=1).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, bench)
    assert sorted(r["n_hit"] for r in got) == [0, 11, 11, 22]


def test_filter_keeps_clean_rows_and_columns(spark):
    docs, bench = corpus()
    df, b = frames(spark, docs, bench)
    kept = D.decontaminate(df, b)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in brute(docs, bench) if not r[5])


def test_empty_tables(spark):
    docs, bench = corpus()
    df, b = frames(spark, docs, bench)
    assert D.contamination_report(df.limit(0), b).collect() == []
    assert not any(r["contaminated"] for r in D.contamination_report(df, b.limit(0)).collect())
