import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import contract, scalars
from tessera.operators import tree
from tessera.plans import extract, verify
from tessera.sources.html import shred

PAGE = """<html lang="en-us"><head><title>Disks | Azure</title><meta name="description" content="d"></head><body class="en-us">
<tags ms.service="disks"></tags><div class="pure-content">
<div class="common-banner"><h1>Disks</h1></div>
<div class="intro"><p>About &amp; more</p></div><div class="hide-info">no</div>
<div class="technical-azure-selector"><div class="scroll-table" id="s"><table id="a"><tr><td>1</td></tr></table><span data-table-id="a2"></span></div>
<table id="b"><tr><td>2</td></tr></table><i class="icon-tick"></i></div>
<div class="pricing-page-section"><h2>FAQ</h2><div class="more-detail"><p>why</p></div></div>
<div class="pricing-page-section"><h2>Support and SLA</h2><p>99</p></div>
</div></body></html>"""


def pages(spark, *html):
    return spark.createDataFrame([(i, h) for i, h in enumerate(html)], "page_id long, html string")


def test_unclosed_and_stray_tags(spark):
    nodes = shred(pages(spark, "<html><body><p>a<b>c</p></i><br>d<script>if (a < b) '</p>'</script></body></html>")).where("kind = 'element'")
    got = {r["tag"]: (r["pre"], r["last"]) for r in nodes.collect()}
    assert got["p"] == (2, 5) and got["b"] == (4, 5) and got["br"][0] == got["br"][1]


def test_errors_are_rows(spark):
    got = {(r["item_id"], r["error"]) for r in shred(pages(spark, None, " ", "<p>x</p>", "<html><body></body></html>")).where("kind = 'error'").collect()}
    assert got == {(0, "empty page"), (1, "empty page"), (2, "no html, no body")}
    assert shred(pages(spark).limit(0)).collect() == []


def test_text_and_html_of_subtrees(spark):
    nodes = shred(pages(spark, '<html><body><div id="x" class="a b">1 &lt; 2<!-- c --><p> t <img src="u"></p></div></body></html>')).cache()
    root = nodes.where("id = 'x'")
    assert tree.subtree_text(root, nodes).first()["text"] == "1 < 2 t"
    assert tree.subtree_html(root, nodes).first()["html"] == '<div id="x" class="a b">1 &lt; 2<!-- c --><p> t <img src="u"/></p></div>'
    assert tree.subtree_html(root, nodes, nodes.where("tag = 'p'")).first()["html"] == '<div id="x" class="a b">1 &lt; 2<!-- c --></div>'


def test_simple_page(spark):
    nodes = shred(pages(spark, PAGE, PAGE.replace("technical-azure-selector", "other"))).cache()
    items = spark.createDataFrame([(0, "en-us", "disks"), (1, "en-us", "disks")], "item_id long, language string, slug string")
    payloads, errors = extract.extract_simple(nodes, items)
    payload = payloads.first()["payload"]
    assert [r["item_id"] for r in errors.collect()] == [1]
    assert payload["baseContent"].startswith('<div class="technical-azure-selector">') and "✓" in payload["baseContent"]
    assert [s["sectionType"] for s in payload["commonSections"]] == ["Banner", "ProductDescription", "Qa"]
    assert payload["commonSections"][1]["content"] == '<div class="intro"><p>About &amp; more</p></div>'
    assert payload["commonSections"][2]["content"].startswith('<div class="more-detail">') and "99" in payload["commonSections"][2]["content"]
    rules = contract.pricing_rules(F.col("payload"), F.lit("simple_static"), F.lit("disks"), F.lit("en-us"))
    assert contract.violations(payloads, rules).collect() == []
    assert contract.schema_violations(payloads.schema["payload"].dataType, contract.PRICING_FIELDS) == []


def test_pricing_heading_without_selector(spark):
    html = '<html><body><tags ms.service="x"></tags><div class="pure-content"><div class="common-banner">B</div><h2>Pricing details：</h2><p>t</p><div><table><tr><td>1</td></tr></table></div><div class="pricing-page-section">Service Level Agreement</div></div></body><title>T</title></html>'
    nodes = shred(pages(spark, html)).cache()
    payloads, errors = extract.extract_simple(nodes, spark.createDataFrame([(0, "en-us", "x")], "item_id long, language string, slug string"))
    assert errors.collect() == []
    assert payloads.first()["payload"]["baseContent"] == "<h2>Pricing details：</h2><p>t</p><div><table><tr><td>1</td></tr></table></div>"


def test_regions_lose_whole_units(spark):
    nodes = shred(pages(spark, PAGE)).cache()
    bodies = nodes.where(tree.has_class("technical-azure-selector")).select("item_id", "pre", "last")
    lookups = spark.createDataFrame([(0, "east", ["a2"]), (0, "west", ["b", "zz"]), (0, "north", [])], "item_id long, region string, table_ids array<string>")
    got = {r["region"]: r["content"] for r in extract.project_regions(nodes, bodies, lookups).collect()}
    assert 'id="a"' not in got["east"] and 'id="b"' in got["east"] and "scroll-table" not in got["east"]
    assert 'id="a"' in got["west"] and 'id="b"' not in got["west"]
    assert 'id="a"' in got["north"] and 'id="b"' in got["north"]


def test_support_article(spark):
    html = "<html><title>Law | Azure</title><body><h1>Law</h1><div><p>one</p></div><p>two</p><h2>Part</h2>bare<!-- no --><p>three</p></body></html>"
    nodes = shred(pages(spark, html)).cache()
    row = extract.extract_support(nodes, nodes.select("item_id").distinct()).first()
    assert (row["title"], row["description"], row["main"]) == ("Law", "<p>one</p><p>two</p>", "<h2>Part</h2>bare<p>three</p>")


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        (' a \n <div> </div><p> <b>x</b> </p>', "a <p><b>x</b></p>"),
        ("<div> <div> </div> </div>", "<div></div>"),
        ('<!-- <i class="icon-tick"></i> --><i class="x icon-tick y"> </i><i class="icon-ticks"></i>', '<!-- <i class="icon-tick"></i> -->✓<i class="icon-ticks"></i>'),
        ('<img src="/a"><img src="//b"><img src="/{base_url}/c"><p data-x="/Images/d">', '<img src="{base_url}/a"><img src="//b"><img src="/{base_url}/c"><p data-x="{base_url}/Images/d">'),
        ("x 　y", "x y"),
        ("", ""),
    ],
)
def test_normalize(spark, given, expected):
    df = spark.createDataFrame([(given,)], "h string")
    assert df.select(scalars.normalize_html(F.col("h"))).first()[0] == expected


def test_scalars(spark):
    df = spark.createDataFrame([("https://x/details/a/b/index.html?q", "abcd", "abXd", "Region：", "a/../b")], "url string, a string, b string, label string, path string")
    got = df.select(
        scalars.slug(F.col("url")), scalars.first_difference(F.col("a"), F.col("b")), scalars.first_difference(F.col("a"), F.col("a")), scalars.display_name(F.col("label"), "x"), scalars.is_safe_path(F.col("path")),
        scalars.group_name(F.array("a", "b")), scalars.group_name(F.array("a", F.lit("c - d"))), scalars.article_title(F.lit("T | Azure ")), scalars.is_visible(F.lit("Display : NONE")),
    ).first()
    assert tuple(got) == ("a_b", 3, None, "Region", False, "abcd - abXd", None, "T", False)


def test_contract_finds_each_broken_rule(spark):
    option = {"value": "n", "label": "N", "href": "#n", "isActive": True, "isDefault": True}
    filters = json.dumps({"filterDefinitions": [{"filterKey": "region", "filterType": "dropdown", "displayName": "R", "options": [option]}]})
    group = {"groupName": "N", "filterCriteriaJson": '[{"filterKey":"region","matchValues":"n"}]', "content": "c", "sortOrder": 1, "isActive": True, "sharedContent": None}
    good = {"title": "T", "metaTitle": "", "metaDescription": "", "metaKeywords": "", "slug": "k", "language": "zh-cn", "baseContent": "", "contentGroups": [group], "commonSections": [{"sectionType": "Banner", "sectionTitle": "Banner", "content": "b", "sortOrder": 1, "isActive": True}], "pageConfig": {"displayTitle": "T", "pageIcon": contract.PAGE_ICON, "leftNavigationIdentifier": "x", "pageType": "RegionFilter", "enableFilters": True, "filtersJsonConfig": filters}}
    cases = [good, good | {"title": " "}, good | {"contentGroups": [group | {"sortOrder": 2}]}, good | {"contentGroups": [group, group | {"sortOrder": 2}]}, good | {"contentGroups": [group | {"filterCriteriaJson": '[{"filterKey":"region","matchValues":"z"}]'}]}, good | {"commonSections": []}]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"item_id long, payload struct<{contract.PRICING_SCHEMA.replace(' ', ':').replace(',:', ',')}>")
    found = {}
    for r in contract.violations(df, contract.pricing_rules(F.col("payload"), F.lit("region_filter"), F.lit("k"), F.lit("zh-cn"))).collect():
        found.setdefault(r["item_id"], set()).add(r["rule"])
    assert 0 not in found
    assert found[1] >= {"R04 title", "R32 display title"}
    assert found[2] == {"R20 group order"} and found[3] == {"R14 unique criteria"} and found[4] == {"R13 domain"} and "R25 sections" in found[5]


def test_tree_difference_catches_mutations(spark):
    a = {"g": [{"n": "x"}, {"n": "y"}], "t": "s", "k": 1}
    cases = [a, a | {"t": "other"}, a | {"g": [{"n": "y"}, {"n": "x"}]}, a | {"g": [{"n": "x"}]}, a | {"k": "1"}, {"g": a["g"], "t": "s"}]
    first = spark.createDataFrame([(i, json.dumps(a)) for i in range(len(cases))] + [(9, "{")], "id long, json string")
    second = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)] + [(9, "{")], "id long, json string")
    status = {r["id"]: r["status"] for r in verify.repeat_check(first, second, "id", "json").collect()}
    assert status == {0: "passed", 1: "failed", 2: "failed", 3: "failed", 4: "failed", 5: "failed", 9: "blocked"}


def test_texts_meet_in_one_join(spark):
    """The rows of the path tables, from texts compared in place: a plan that shuffles every path has four exchanges."""
    a = {"g": [{"n": "x"}, {"n": "y"}], "t": "s", "k": 1, "e": {}}
    cases = [a, a | {"k": 1.0}, a | {"k": True}, a | {"g": {"n": [1]}}, a | {"g": []}, a | {"e": {"z": [None]}}, dict(reversed(a.items())), a | {"t": None}]
    texts = lambda values: spark.createDataFrame([(i, v) for i, v in values], "id long, json string")
    old = texts([(i, json.dumps(a)) for i in range(len(cases))] + [(20, "{"), (21, "{"), (22, None), (23, "1")])
    new = texts([(i, json.dumps(c)) for i, c in enumerate(cases)] + [(20, "["), (21, "{"), (22, "1"), (24, "[2]")])
    wanted = verify.tree_difference(verify.json_paths(old, "id", "json"), verify.json_paths(new, "id", "json"), "id")
    found = verify.text_difference(old, new, "id", "json")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 2 and plan.count("MapInArrow") == 1 and "MapInPandas" not in plan
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    status = {r["id"]: r["status"] for r in verify.repeat_check(old, new, "id", "json").collect()}
    assert status[0] == "passed" and status[21] == status[22] == "blocked" and {status[i] for i in (*range(1, 8), 23, 24)} == {"failed"}


def test_payload_text_is_made_once(spark):
    """No part's text stands twice in the expression, however deep it is nested; empty structs and arrays, nulls and escapes keep their text."""
    from tessera.functions import canonical

    value = "named_struct('a', array(named_struct('b', array(named_struct('c', array(named_struct('q\"', s)), 'd', null_text)))), 'e', named_struct('f', null_text), 'g', array())"
    rows = spark.createDataFrame([('x"\\\n\x01é',), ("plain",)], "s string").selectExpr("s", "if(s is null, '', cast(null as string)) as null_text").selectExpr("s", f"{value.replace('array())', 'cast(array() as array<string>))')} as v")
    made = rows.select("s", canonical.payload_text(F.col("v"), rows.schema["v"].dataType).alias("t"))
    for r in made.collect():
        assert r["t"] == json.dumps({"a": [{"b": [{"c": [{'q"': r["s"]}]}]}], "e": {}, "g": []}, ensure_ascii=False, indent=2) + "\n"
    # four places of strings: q", d, f and the elements of g
    assert made._jdf.queryExecution().logical().toString().count("[\\x00-\\x1f]") == 4


def test_checks_import_nothing_of_the_extraction():
    import ast
    import inspect

    names = {n.module or "" for n in ast.walk(ast.parse(inspect.getsource(verify))) if isinstance(n, ast.ImportFrom)}
    assert not any(n.startswith("tessera") for n in names)
