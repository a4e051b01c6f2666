"""Every query that has SQL gives the rows that DuckDB gives on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tessera.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def rows(raw):
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in raw)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, FOLDER)
    names = sorted(found.columns)
    there = database.sql(ORACLES[name])
    assert sorted(there.columns) == names
    expected = database.sql(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({ORACLES[name]})").fetchall()
    assert rows(found.select(*names).collect()) == rows(expected)


def test_every_query_has_sql_or_a_test_of_its_own():
    assert set(QUERIES) - set(ORACLES) == {"extract_simple", "project_regions", "support_article_split"}


def test_character_references_of_titles(spark, tmp_path):
    """Cut, numbered and long references in titles and headings, as HTML reads them."""
    texts = ["a &amp; b &amp", "cut &am", "&quot;q&quot", "&#39;x&#x27;y&#x27", "&#x2", "&#x80; &#128 &#0; &#xD800; &#99999999999999999999;", "&amp;lt; &ltfoo; &notit; &notin; &;", "&eacute;t&eacute &NewLine;", " &nbsp;", "&#; &#x; & &", "x&ampamp;"]
    pages = [(i, f"https://host/en/{i}", f'<html lang="en"><head><title>{t}</title></head><body><h1>{t}</h1></body></html>') for i, t in enumerate(texts)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    wanted = rows(connection.execute(ORACLES["page_metadata"]).fetchall())
    assert rows(QUERIES["page_metadata"](spark, str(tmp_path)).collect()) == wanted
    assert ("0", "a & b &", "a & b &", "en") in wanted


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_complex_pages_are_read_a_second_time_once(spark, monkeypatch):
    """The fields of the second reading serve the statuses too."""
    from tessera.plans import independent

    names, real = [], independent.staged
    monkeypatch.setattr(independent, "staged", lambda df, name: names.append(name) or real(df, name))
    QUERIES["second_complex_bodies"](spark, FOLDER)
    assert names.count("second-stream") == 1
