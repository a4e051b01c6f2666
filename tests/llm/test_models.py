import random

import numpy as np
import pytest

from tessera.llm import quality, toxicity
from tessera.llm.labelled import fit_logistic

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("report", "label", "least"), [(toxicity.toxicity_report, "toxic", 0.93), (quality.quality_report, "quality", 0.93)])
def test_held_out_accuracy(spark, report, label, least):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = report(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    assert (held["predicted"] == held[label]).mean() >= least
    assert held["score"].between(0, 1).all()


def test_held_out_labels_are_never_used(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0 then 1 - toxic else toxic end as toxic")
    a, b = toxicity.learn(docs, labels), toxicity.learn(docs, turned)
    assert (a.words, a.beginnings, a.weights) == (b.words, b.beginnings, b.weights)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_nulls_empty_texts_and_no_labels(spark, module):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 20000), (None, "x"), (3, "y")], "doc_id long, text string").selectExpr("doc_id", "text", "1 as id", "2.0 as score")
    empty = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    report = getattr(module, "toxicity_report" if module is toxicity else "quality_report")
    got = report(docs, empty).collect()
    assert len(got) == 5 and len({r["score"] for r in got}) == 1
    assert report(docs.limit(0), empty).collect() == []
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (3, 1, 1), (3, 0, 0)], "doc_id long, toxic int, quality int")
    assert len(report(docs, odd).collect()) == 5


def test_clauses_and_not_words_are_scored():
    grammar = toxicity.Grammar({"fool": 2.0}, {}, [1.0, 2.0, -1.0, -2.0, 1.0, 0.0, 0.0])
    plain, aimed, negated, reported = (grammar.features(t) for t in ("a fool went home", "you are a fool", "he is not a fool", "she said a fool was here"))
    assert plain[0] > 0 and aimed[1] > 0 and negated[2] > 0 and reported[3] > 0
    assert grammar.features("he will soon kill it")[4] > 0 and grammar.features("he was to kill. will it")[4] == 0
    assert grammar.score("you are a fool") > grammar.score("a fool went home") > grammar.score("he is not a fool")


def test_composition_reads_as_its_parts_do():
    table, marks = toxicity.compose(toxicity.PARTS)
    rng = np.random.default_rng(1)
    for _ in range(200):
        state, alone = 0, [0] * len(toxicity.PARTS)
        for tag in rng.integers(0, 7, 12).tolist():
            state = table[state][tag]
            alone = [p.step.get((s, tag), p.rest[s]) for p, s in zip(toxicity.PARTS, alone, strict=True)]
            assert marks[state] == frozenset().union(*(p.marks.get(s, frozenset()) for p, s in zip(toxicity.PARTS, alone, strict=True)))


def test_logistic_of_one_class():
    assert fit_logistic(np.zeros((3, 1)), np.ones(3))[-1] > 0
    assert fit_logistic(np.zeros((0, 1)), np.ones(0))[-1] == 0


def test_lowest_hashes_are_those_of_a_full_sort(spark):
    from pyspark.sql import functions as F

    from tessera.llm.labelled import lowest_hashes

    ids = spark.range(100_000)
    plain = [r["id"] for r in ids.orderBy(F.xxhash64("id"), "id").limit(50).collect()]
    assert [r["id"] for r in lowest_hashes(ids, "id", 50, 100_000).collect()] == plain


def plain_features(text, words, beginnings):
    """Clause by clause with plain rules on word places, no automaton."""
    import math
    import re

    fixed = {w: tag for tag, listed in toxicity.WORDS.items() for w in listed.split()}
    total = dict.fromkeys(["plain", "aimed", "negated", "reported", "threat"], 0.0)
    strongest = 0.0
    for clause in re.split(r"[.!?;:,\n()\[\]\"“”«»]+", text.lower()):
        said = re.findall(r"[^\W\d_]+(?:'[a-z]+)?", clause)
        weights = [max([words.get(w, 0.0), *(beginnings.get(w[:n], 0.0) for n in (4, 5, 6) if len(w) >= n)]) for w in said]
        tags = [toxicity.INSULT if x > 0 else fixed.get(w, toxicity.OTHER) for w, x in zip(said, weights)]
        places = lambda tag: [i for i, t in enumerate(tags) if t == tag]
        insults = places(toxicity.INSULT)
        total["threat"] += any(0 < h - m <= 4 for m in places(toxicity.MODAL) for h in places(toxicity.HARM))
        if insults:
            negated = any(0 < i - n <= 3 for i in insults for n in places(toxicity.NEGATION))
            kind = "reported" if places(toxicity.SPEECH) else "negated" if negated else "aimed" if places(toxicity.TARGET) else "plain"
            total[kind] += sum(weights[i] for i in insults)
            if kind in ("aimed", "plain"):
                strongest = max(strongest, *(weights[i] for i in insults))
    return [math.log1p(x) for x in total.values()] + [strongest]


def logistic(weights, x):
    z = sum(w * v for w, v in zip(weights, [*x, 1.0], strict=True))
    return round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 6)


def test_toxicity_scores_equal_plain_clause_rules(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    grammar = toxicity.learn(docs, labels)
    assert grammar.words or grammar.beginnings
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, labels).collect()}
    for r in docs.collect():
        x = plain_features(r["text"] or "", grammar.words, grammar.beginnings)
        assert abs(got[r["doc_id"]] - logistic(grammar.weights, x)) < 2e-6, r["doc_id"]


def test_plain_clause_rules_on_made_up_clauses():
    rng = np.random.default_rng(7)
    listed = [w for tag in toxicity.WORDS.values() for w in tag.split()[:6]] + ["fool", "rotten", "rottenness", "house", "green", ".", ",", "\n"]
    grammar = toxicity.Grammar({"fool": 2.0}, {"rott": 1.5}, [1.0] * 7)
    for _ in range(3000):
        text = " ".join(rng.choice(listed, rng.integers(0, 14)))
        assert np.allclose(grammar.features(text), plain_features(text, grammar.words, grammar.beginnings)), text


def test_arcs_pass_the_bounds_and_none_is_left_out(spark):
    """Counts made anew in plain Python over the same sample give the same arcs."""
    import math

    from tessera.llm.labelled import fold, sample

    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = sample(docs, labels, "toxic", fold("doc_id", 5) != 0, toxicity.SAMPLE).collect()
    import xxhash

    apart = {}
    for r in sorted(held, key=lambda r: r["id"], reverse=True):
        shapes = toxicity._shapes(r["text"])
        least = sorted(xxhash.xxh64_intdigest(w) for w in shapes if not w.endswith("*"))[: toxicity._MINIMA]
        apart[tuple(least), r["y"]] = shapes
    n = {y: sum(k[1] == y for k in apart) for y in (0, 1)}
    count = {y: {} for y in (0, 1)}
    for (_, y), shapes in apart.items():
        for shape in shapes:
            count[y][shape] = count[y].get(shape, 0) + 1
    expected = {}
    for shape, a in count[1].items():
        b = count[0].get(shape, 0)
        share, rate = a / (a + b), n[1] / (n[0] + n[1])
        surprise = (a + b) * (share * math.log(share / rate) + ((1 - share) * math.log((1 - share) / (1 - rate)) if b else 0.0))
        weight = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
        if a >= 3 and share > rate and weight >= 3.4 and surprise >= 13.0:
            expected[shape] = weight
    grammar = toxicity.learn(docs, labels)
    found = grammar.words | {f"{w}*": x for w, x in grammar.beginnings.items()}
    assert found.keys() == expected.keys() and all(abs(found[k] - expected[k]) < 1e-3 for k in found)


def test_quality_scores_equal_plain_block_sizes(spark):
    import zstandard

    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = quality.learn(docs, labels)
    assert found.good and found.bad

    def size(raw, known):
        press = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, dict_data=zstandard.ZstdCompressionDict(known))
        return sum(len(press.compress(raw[i : i + 2048])) for i in range(0, len(raw), 2048))

    got = {r["doc_id"]: r["score"] for r in quality.quality_report(docs, labels).collect()}
    for r in docs.collect():
        raw = (r["text"] or "").encode()
        a, b = size(raw, found.good), size(raw, found.bad)
        assert abs(got[r["doc_id"]] - logistic(found.weights, [100 * (b - a) / (a + b) if a + b else 0.0])) < 2e-6, r["doc_id"]


def test_blocks_of_long_texts_are_all_there(spark):
    rows = spark.createDataFrame([(1, "a" * 5000, 1), (2, "", 1), (3, "é" * 2000, 0)], "h long, text string, y int")
    got = sorted((r["y"], len(r["block"])) for r in quality._blocks(rows).collect())
    assert got == [(0, 1952), (0, 2048), (1, 904), (1, 2048), (1, 2048)]


def test_different_texts_that_share_a_word_all_teach(spark):
    """Sixty toxic texts with one word in common, of which some word has the least hash of all, count sixty times; of near
    copies one stands for all."""
    rng = random.Random(2)
    filler = [f"{a}{b}{c}" for a in "bcdf" for b in "aeio" for c in "lmnr"]
    body = lambda: " ".join(rng.choices(filler, k=30))
    rows = [(i, f"you zorblax {body()}", 1) for i in range(60)] + [(100 + i, body(), 0) for i in range(200)]
    copy = " ".join(f"w{j}" for j in range(40))
    rows += [(1000 + i, f"{copy} qumple", 1) for i in range(50)]
    words, _ = toxicity._arcs(spark.createDataFrame(rows, "id long, text string, y int"))
    assert "zorblax" in words and "qumple" not in words
