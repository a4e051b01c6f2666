import json

from tessera.operators.changes import definition_changes
from tessera.sources import definitions as D


def definition(key, **changes):
    source = lambda lang: {"availability": "available", "snapshot_path": f"{lang}/{key}.html", "url": f"https://x/{lang}/details/{key}"}
    base = {"schema_version": "1", "product_key": key, "display_name": key.title(), "slug": key, "page_model": "FlexibleContentPage", "capability_status": "any", "catalog_categories": [" Compute "], "sources": {"zh-cn": source("zh-cn"), "en-us": source("en-us")}, "extraction": {"semantic_strategy": "complex"}}
    return base | changes


def write(folder, rows):
    folder.mkdir(parents=True, exist_ok=True)
    for name, row in rows.items():
        (folder / f"{name}.json").write_text(row if isinstance(row, str) else json.dumps(row, ensure_ascii=False), encoding="utf-8")


def test_definitions_scope_and_exclusions(spark, tmp_path):
    write(tmp_path / "pricing", {
        "disks": definition("disks"), "vm": definition("vm", extraction={"semantic_strategy": "simple_static", "page_global_content": {"source_boundary": "b"}}),
        "bad_key": definition("bad_key"), "other": definition("not-other"), "wrong": definition("wrong", extraction={"semantic_strategy": "support_article"}),
        "escape": definition("escape", sources={"zh-cn": {"snapshot_path": "../x"}, "en-us": {"snapshot_path": "a"}}), "half": definition("half", sources={"zh-cn": {"snapshot_path": "a"}}), "twice": definition("twice"), "bare": definition("bare", catalog_categories=[]),
    })
    write(tmp_path / "support", {"law": definition("law", page_model="SupportArticlePage", support_article_type="LEGAL", extraction={"semantic_strategy": "support_article"}), "twice": definition("twice", page_model="SupportArticlePage", support_article_type="SLA", extraction={"semantic_strategy": "support_article"})})
    good, errors = D.read_definitions(spark, {k: f"{tmp_path}/{k}" for k in ("pricing", "support")})
    assert {r["product_key"]: (r["strategy"], r["categories"], r["boundary"]) for r in good.collect()} == {"disks": ("complex", ["compute"], None), "vm": ("simple_static", ["compute"], "b"), "law": ("support_article", ["compute"], None)}
    told = {(r["product_key"], r["error"]) for r in errors.collect()}
    assert told == {("bad_key", "key"), ("not-other", "file name"), ("wrong", "strategy"), ("escape", "path"), ("half", "languages"), ("twice", "duplicate key"), ("bare", "categories")}
    paths = {(r["product_key"], r["language"]): r["frozen_path"] for r in D.definition_sources(good).collect()}
    assert paths["law", "en-us"] == "en-us/support/legal/law.html" and paths["vm", "zh-cn"] == "zh-cn/pricing/vm.html"
    write(tmp_path, {"scope": {"schema_version": "1", "languages": ["zh-cn", "en-us"], "product_keys": ["disks", "law", "zzz"], "strategy_overrides": {"disks": {"strategy": "simple_static", "reason": "why"}, "law": {"strategy": "complex", "reason": "x"}, "vm": {"strategy": "complex", "reason": "x"}}}})
    scope, overrides, wrong = D.read_scope(spark, f"{tmp_path}/scope.json", good)
    assert [r["product_key"] for r in scope.orderBy("p_ord").collect()] == ["disks", "law", "zzz"]
    assert [r["product_key"] for r in overrides.collect()] == ["disks"]
    assert {(r["product_key"], r["error"]) for r in wrong.collect()} == {("zzz", "unknown key"), ("law", "override of a support page"), ("vm", "override out of scope")}
    write(tmp_path, {"soft": json.dumps([{"os": " a", "region": "r", "tableIDs": [" #t", "t", "# u"]}])})
    row = D.read_exclusions(spark, f"{tmp_path}/soft.json").first()
    assert (row["os"], row["table_ids"], row["error"]) == ("a", ["t", " u"], None)


def test_a_scope_out_of_order(spark, tmp_path):
    write(tmp_path / "pricing", {"disks": definition("disks")})
    good, _ = D.read_definitions(spark, {"pricing": f"{tmp_path}/pricing"})
    write(tmp_path, {"scope": {"languages": ["en-us", "zh-cn"], "product_keys": ["disks", "disks"]}, "torn": "{"})
    _, _, wrong = D.read_scope(spark, f"{tmp_path}/scope.json", good)
    assert {r["error"] for r in wrong.collect()} == {"languages", "keys not sorted and unique"}
    _, _, torn = D.read_scope(spark, f"{tmp_path}/torn.json", good)
    assert "unreadable" in {r["error"] for r in torn.collect()}


def test_changed_definitions(spark, tmp_path):
    write(tmp_path / "a", {"disks": definition("disks"), "vm": definition("vm")})
    write(tmp_path / "b", {"disks": definition("disks", display_name="New", slug="other"), "vm": definition("vm", extraction={"semantic_strategy": "complex", "page_global_content": {"source_boundary": "b"}})})
    old, new = (D.definition_baseline(D.read_definitions(spark, {"pricing": f"{tmp_path}/{x}"})[0]) for x in "ab")
    got = definition_changes(old, new, [c for c in old.columns if c != "product_key"]).collect()
    assert [tuple(r) for r in got] == [("vm", "boundary")]
