import pytest
from pyspark.sql import functions as F

from tessera.sources import freeze as Z
from tessera.sources.stages import StageError

SCHEMA = "product_key string, language string, content string"
LANGUAGES = ["en-us", "zh-cn"]


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def freeze(spark, root, plan, table):
    return Z.freeze(spark, root, plan, table if callable(table) else lambda: table, languages=LANGUAGES)


def pairs(spark, *products):
    return spark.createDataFrame([(p, x) for p in products for x in LANGUAGES], "product_key string, language string")


def now(spark, root):
    return {(r["product_key"], r["language"]): r["content"] for r in Z.current(spark, root, SCHEMA).collect()}


def test_both_languages_or_none(spark, tmp_path):
    root = str(tmp_path)
    first = rows(spark, ("a", "en-us", "A"), ("a", "zh-cn", "甲"), ("b", "en-us", "B"), ("b", "zh-cn", "乙"))
    report = freeze(spark, root, pairs(spark, "a", "b"), first)
    assert {(r["action"], r["n_bytes"]) for r in report.collect()} == {("copied", 1), ("copied", 3)}
    second = rows(spark, ("a", "en-us", "A2"), ("a", "zh-cn", "甲"), ("b", "en-us", "B2"), ("b", "zh-cn", ""), ("c", "en-us", "C"))
    plan = pairs(spark, "a", "b").unionByName(spark.createDataFrame([("c", "en-us"), ("d", "en-us"), ("d", "en-us"), ("d", "zh-cn")], "product_key string, language string"))
    told = {(r["product_key"], r["language"]): (r["action"], r["error"]) for r in freeze(spark, root, plan, second).collect()}
    assert told["a", "en-us"] == ("updated", None) and told["a", "zh-cn"] == ("unchanged", None)
    assert told["b", "en-us"] == told["b", "zh-cn"] == ("blocked", "source missing or empty")
    assert told["c", "en-us"] == ("blocked", "languages of the plan: en-us") and told["d", "en-us"][0] == "blocked"
    assert now(spark, root) == {("a", "en-us"): "A2", ("a", "zh-cn"): "甲", ("b", "en-us"): "B", ("b", "zh-cn"): "乙"}
    assert Z.versions(spark, root) == [0, 1] and Z.current(spark, root, SCHEMA, 0).count() == 4


@pytest.mark.parametrize("at", ["write", "half a write", "rename"])
def test_a_failure_leaves_the_old_pair(spark, tmp_path, monkeypatch, at):
    root = str(tmp_path)
    freeze(spark, root, pairs(spark, "a"), rows(spark, ("a", "en-us", "A"), ("a", "zh-cn", "甲")))
    whole = Z.written

    def torn(df, path):
        if at == "half a write":
            df.where("language = 'en-us'").write.parquet(path)
        if at != "rename":
            raise OSError("disk")
        return whole(df, path)

    def no_rename(*_):
        raise OSError("gone")

    monkeypatch.setattr(Z, "written", torn)
    if at == "rename":
        monkeypatch.setattr(Z, "seal", no_rename)
    with pytest.raises(OSError):
        freeze(spark, root, pairs(spark, "a"), rows(spark, ("a", "en-us", "A2"), ("a", "zh-cn", "乙")))
    assert now(spark, root) == {("a", "en-us"): "A", ("a", "zh-cn"): "甲"} and Z.versions(spark, root) == [0]
    monkeypatch.undo()
    freeze(spark, root, pairs(spark, "a"), rows(spark, ("a", "en-us", "A2"), ("a", "zh-cn", "乙")))
    assert now(spark, root) == {("a", "en-us"): "A2", ("a", "zh-cn"): "乙"}


def test_a_source_that_changes_while_it_is_copied(spark, tmp_path, monkeypatch):
    root, source = f"{tmp_path}/frozen", f"{tmp_path}/source"
    rows(spark, ("a", "en-us", "A"), ("a", "zh-cn", "甲"), ("b", "en-us", "B"), ("b", "zh-cn", "乙")).write.parquet(source)
    real = Z.staged

    def then_changed(df, name):
        out = real(df, name)
        if name == "sources":
            rows(spark, ("a", "en-us", "A"), ("a", "zh-cn", "丙"), ("b", "en-us", "B"), ("b", "zh-cn", "乙")).write.mode("overwrite").parquet(source)
        return out

    monkeypatch.setattr(Z, "staged", then_changed)
    report = freeze(spark, root, pairs(spark, "a", "b"), lambda: spark.read.schema(SCHEMA).parquet(source))
    told = {(r["product_key"], r["error"]) for r in report.collect()}
    assert told == {("a", "source changed while it was copied"), ("b", None)}
    assert set(now(spark, root)) == {("b", "en-us"), ("b", "zh-cn")}


def test_of_two_writers_the_later_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    given = rows(spark, ("a", "en-us", "A"), ("a", "zh-cn", "甲"))
    real = Z.written

    def overtaken(df, path):
        monkeypatch.setattr(Z, "written", real)
        freeze(spark, root, pairs(spark, "a"), given.withColumn("content", F.lit("first")))
        return real(df, path)

    monkeypatch.setattr(Z, "written", overtaken)
    with pytest.raises(StageError, match="another freeze"):
        freeze(spark, root, pairs(spark, "a"), given)
    assert set(now(spark, root).values()) == {"first"}
