import json

from pyspark.sql import functions as F

from tessera.functions import contract
from tessera.plans import filtered, independent, run
from tessera.sources.html import shred

from .test_states import REGIONS, SOFTWARE, control
from .test_tree_and_plans import PAGE


def items(spark, n, slug="disks"):
    return spark.createDataFrame([(i, f"p{i // 2}", "en-us", slug) for i in range(n)], "item_id long, product_key string, language string, slug string")


def test_run_accounts_for_every_item(spark, tmp_path):
    pages = spark.createDataFrame([(0, PAGE), (1, PAGE.replace("technical-azure-selector", "x")), (2, PAGE), (3, None), (4, PAGE.replace("<title>Disks | Azure</title>", "<title> </title>"))], "item_id long, html string")
    result = run.run_simple(items(spark, 6), pages)
    got = {r["item_id"]: (r["status"], r["reason"]) for r in result.items.collect()}
    assert got == {0: ("passed", ""), 1: ("blocked", "extraction"), 2: ("passed", ""), 3: ("blocked", "input"), 4: ("blocked", "extraction"), 5: ("blocked", "input")}
    summary = {r["grain"]: (r["planned"], r["passed"], r["blocked"]) for r in result.summary.collect()}
    assert summary == {"items": (6, 2, 4), "products": (3, 0, 3)}
    assert run.write_batch(result, f"{tmp_path}/run-1")
    assert spark.read.parquet(f"{tmp_path}/run-1/payloads").count() == 2


def test_the_second_reading_catches_a_cut_body(spark):
    nodes = shred(spark.createDataFrame([(0, PAGE), (1, PAGE)], "page_id long, html string")).cache()
    body = independent.selector_bodies(nodes).where("item_id = 0").first()
    assert body["bodies"] == 1 and body["baseContent"].startswith('<div class="technical-azure-selector">')
    cut = spark.createDataFrame([(0, body["baseContent"]), (1, body["baseContent"][:-20])], "item_id long, b string").select("item_id", F.struct(F.col("b").alias("baseContent")).alias("payload"))
    assert {r["item_id"]: r["status"] for r in independent.check_simple(cut, nodes).collect()} == {0: "passed", 1: "failed"}


def region_page(body):
    return f'<html><head><title>T</title></head><body><tags ms.service="s"></tags><div class="pure-content"><div class="common-banner">B</div><div class="technical-azure-selector">{control("software-kind", SOFTWARE[:1], "Linux", True)}{control("region", REGIONS, "East")}{body}</div><p>after</p><div class="pricing-page-section">Support &amp; SLA</div></div></body></html>'


def test_region_pages(spark):
    body = '<table id="a"></table><table id="b"></table>'
    nodes = shred(spark.createDataFrame([(0, region_page(body)), (1, region_page(body + '<table id="a"></table>')), (2, region_page("<table></table>"))], "page_id long, html string")).cache()
    rules = spark.createDataFrame([("tabContent1-value", "east", ["a"])], "os string, region string, table_ids array<string>")
    payloads, errors = filtered.extract_region(nodes, items(spark, 3, "k"), rules)
    assert {(r["item_id"], r["error"]) for r in errors.collect()} == {(1, "several units"), (2, "no unit")}
    payloads = payloads.cache()
    payload = payloads.first()["payload"]
    assert [g["groupName"] for g in payload["contentGroups"]] == ["East", "North"]
    assert 'id="a"' not in payload["contentGroups"][0]["content"] and 'id="a"' in payload["contentGroups"][1]["content"]
    assert json.loads(payload["pageConfig"]["filtersJsonConfig"])["filterDefinitions"][0]["displayName"] == "region"
    rules = contract.pricing_rules(F.col("payload"), F.lit("region_filter"), F.lit("k"), F.lit("en-us"))
    assert contract.violations(payloads, rules).collect() == []


def test_page_global_content(spark):
    pages = [region_page(""), region_page("").replace("</div></body>", "<p>late</p></div></body>"), region_page("").replace("<p>after</p>", "")]
    nodes = shred(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")).cache()
    wanted = items(spark, 4).withColumn("boundary", F.when(F.col("item_id") < 3, F.lit(filtered.AFTER_SELECTOR)))
    content, errors = filtered.page_global_content(nodes, wanted)
    assert {(r["item_id"], r["error"]) for r in errors.collect()} == {(1, "material behind common sections"), (2, "empty base content")}
    assert {r["item_id"]: r["baseContent"] for r in content.collect()}[0] == "<p>after</p>"


UNITS = '<div class="scroll-table"><p>u</p><div class="scroll-table"><table id="a"></table></div><i>v</i></div><table data-table-id="b"><tr><td>x</td></tr></table><div class="scroll-table"><table id="c"></table></div><p>rest</p>'


def test_a_batch_of_region_pages(spark):
    rules = spark.createDataFrame([("tabContent1-value", "east", ["a", "c"]), ("tabContent1-value", "north", ["b"])], "os string, region string, table_ids array<string>")
    pages = spark.createDataFrame([(0, region_page(UNITS)), (1, None), (2, region_page("<p>no unit</p>")), (3, region_page(UNITS).replace(">East</span>", ">?</span>"))], "item_id long, html string")
    result = run.run_filtered(items(spark, 5, "k"), pages, rules, "region_filter")
    got = {r["item_id"]: (r["status"], r["reason"], r["usage"], r["l3b"]) for r in result.items.collect()}
    assert got[0] == ("passed", "", "passed", "passed")
    assert got[1][:2] == ("blocked", "input") and got[2][:2] == ("blocked", "extraction") and got[3][:2] == ("blocked", "extraction") and got[4][:2] == ("blocked", "input")
    groups = result.payloads.first()["payload"]["contentGroups"]
    assert '<p>u</p><i>v</i></div><table data-table-id="b">' in groups[0]["content"] and 'id="c"' not in groups[0]["content"]
    assert 'data-table-id="b"' not in groups[1]["content"] and 'id="a"' in groups[1]["content"]


def test_the_second_reading_catches_a_wrong_region(spark):
    nodes = shred(spark.createDataFrame([(0, region_page(UNITS)), (1, region_page(UNITS))], "page_id long, html string")).cache()
    rules = spark.createDataFrame([("tabContent1-value", "east", ["a"])], "os string, region string, table_ids array<string>")
    payloads = filtered.extract_region(nodes, items(spark, 2, "k"), rules)[0].cache()
    lookups = run.page_lookups(nodes, rules)
    swapped = payloads.withColumn("payload", F.col("payload").withField("contentGroups", F.when(F.col("item_id") == 0, F.col("payload.contentGroups")).otherwise(F.transform("payload.contentGroups", lambda g: g.withField("content", F.concat(g["content"], F.lit("!")))))))
    assert {r["item_id"]: r["status"] for r in independent.check_regions(swapped, nodes, lookups).collect()} == {0: "passed", 1: "failed"}
    fewer = payloads.withColumn("payload", F.col("payload").withField("contentGroups", F.when(F.col("item_id") == 0, F.col("payload.contentGroups")).otherwise(F.slice("payload.contentGroups", 1, 1))))
    assert {r["item_id"]: r["status"] for r in independent.check_regions(fewer, nodes, lookups).collect()} == {0: "passed", 1: "failed"}
    assert {r["item_id"]: r["status"] for r in independent.check_criteria(fewer).collect()} == {0: "passed", 1: "failed"}
    # the usage report of a page that looks nothing valid up can fail the stage
    usage = run.page_lookups(nodes, rules.unionByName(rules)).groupBy("item_id").agg(F.count("*").alias("n"))
    assert {r["n"] for r in usage.collect()} == {3}
