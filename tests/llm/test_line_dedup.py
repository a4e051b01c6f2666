import hashlib
import random

from tessera.llm import line_dedup as L

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(docs, least=2, length=10):
    held = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc)
    last = lambda d: (d is None, d)
    keeper = {k: min(ids, key=last) for k, ids in held.items() if len(k) >= length and len(ids) >= least}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(12)
    pool = ["ten letter", "nine char", "  Ten Letter\t", "ÀÉÎ Ten letters", "àéî ten letters", "ÀÉÎ ten LETTERS", "", " ", "\x0b a longer line with words \r", "A LONGER line with words", " ten letter", "0123456789", "012345678"]
    pool += [f"line number {i} of the pool" for i in range(40)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(150)]
    docs += [(1000 + i, "a very common line\nown line %d here" % (i % 7)) for i in range(60)]
    odd = [(None, "a line of null ids only\na very common line"), (None, "a line of null ids only"), (None, None), (300, ""), (301, None), (302, "\n\n"), (5, "line number 1 of the pool"), (5, "line number 1 of the pool"), (400, "own repeated line\nown repeated line")]
    odd.append((401, "\n".join(f"long text, line {i % 3000}" for i in range(60000))))
    odd.append((402, "x" * 500000 + "\nlong text, line 7"))
    return docs + odd


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as id", "'h' as h", "'o' as own", "'r' as `row`", "'k' as kept", "'a.b' as `a.b`")


def test_equals_brute_force(spark):
    docs = corpus()
    assert sorted(map(tuple, L.line_report(frame(spark, docs)).collect()), key=str) == brute(docs)


def test_other_thresholds(spark):
    docs = corpus()
    got = L.line_counts(frame(spark, docs), least_length=4, least_documents=5).collect()
    assert sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256((r["kept"] or "").encode()).hexdigest()) for r in got], key=str) == brute(docs, 5, 4)


def test_other_columns_stay(spark):
    docs = corpus()
    table = frame(spark, docs)
    got = L.drop_repeated_lines(table)
    assert got.columns == table.columns
    rows = got.collect()
    assert all((r["id"], r["h"], r["own"], r["row"], r["kept"], r["a.b"]) == (1, "h", "o", "r", "k", "a.b") for r in rows)
    assert sorted((str(r["doc_id"]), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in rows) == sorted((str(r[0]), r[3]) for r in brute(docs))
    assert next(r for r in rows if r["doc_id"] == 301)["text"] is None


def test_empty_table(spark):
    assert L.line_report(frame(spark, corpus()).limit(0)).collect() == []
