import glob
import os

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from tessera.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = QUERIES[name](spark, FOLDER)
    columns = ", ".join(f'"{c}"' for c in found.columns)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, connection.sql(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()))


def test_pipeline_equals_its_parts(spark):
    """Each stage against plain Python over what the stage before kept."""
    import numpy as np
    import public_tokenizers
    import tiktoken

    from tessera.llm import bpe, pseudonyms, toxicity

    from .test_decontaminate import brute as contaminated
    from .test_simhash import brute as linked

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    grammar = toxicity.learn(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [r for r in rows if grammar.score(r[1] or "") < 0.5]
    stays = {r[0] for r in linked(rows) if r[0] == r[2]}
    rows = [r for r in rows if r[0] in stays]
    clean = {r[0] for r in contaminated(rows, bench) if not r[5]}
    rows = [r for r in rows if r[0] in clean]
    new = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ours = bpe.Encoder(bpe.vocabulary_path())
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})
    expected = {i: theirs.encode_ordinary(t or "") for i, t in new.items()}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got.keys() == expected.keys()
    assert all(np.array_equal(got[i], expected[i]) for i in got)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).schema.names == docs.columns


def test_stages_take_empty_tables_nulls_and_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = ["id", "row", "fp", "component", "h", "y", "least", "spans", "score", "packed", "_parts"]
    odd = docs.limit(20).unionByName(spark.createDataFrame([(None, None, None, None, None), (-1, None, "en", "s", None), (-2, "", "en", "s", 0), (-3, "word " * 30000, None, "s", 150000)], docs.schema))
    odd = odd.selectExpr(*docs.columns, *(f"'{n}' as `{n}`" for n in names)).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd, FOLDER)
        assert kept.columns == odd.columns, name
        rows = kept.collect()
        assert all(r[n] == n for r in rows for n in names), name
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in odd.collect()} and None in {r["doc_id"] for r in rows}, name
        assert next(r for r in rows if r["doc_id"] is None)["text"] is None, name
        assert stage(spark, odd.limit(0), FOLDER).collect() == [], name
    last = corpus_pipeline.STAGES[-1][1]
    assert {r["doc_id"]: r["n_tokens"] for r in last(spark, odd, FOLDER).collect() if (r["doc_id"] or -1) < 0}.items() >= {None: 0, -1: 0, -2: 0}.items()
    assert last(spark, odd.limit(0), FOLDER).collect() == []
