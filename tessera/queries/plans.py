"""Extraction, contract and verification plans over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import contract
from tessera.operators import tree
from tessera.plans import extract, verify
from tessera.plans.run import run_or_resume, run_simple
from tessera.sources.commit import shared_path, staged
from tessera.sources.html import shred
from tessera.streaming.snapshots import event_windows as _windows

from .register import registrar

QUERIES, ORACLES, query = registrar()


def _pricing_pages(spark, d):
    """Pages in the shape of pricing pages: banner, selector with two table units, service levels."""
    html = F.col("html")
    for old, new in (
        ("<nav>", '<div class="common-banner">'),
        ("</nav>", "</div>"),
        ("<article>", '<div class="technical-azure-selector"><div class="scroll-table"><table id="t1"><tr><td>1</td></tr></table></div><table data-table-id="t2"></table>'),
        ("</article>", "</div>"),
        ("<footer>", '<div class="pricing-page-section"><h2>Support &amp; SLA</h2>'),
        ("</footer>", "</div>"),
        ("<body>", '<body><tags ms.service="pages"></tags><div class="pure-content">'),
        ("</body>", "</div></body>"),
    ):
        html = F.replace(html, F.lit(old), F.lit(new))
    return spark.read.parquet(f"{d}/pages.parquet").withColumn("html", html)


def _pricing_nodes(spark, d):
    pages = _pricing_pages(spark, d)
    nodes, _ = staged(shred(pages), "nodes")
    items = pages.select(F.col("page_id").alias("item_id"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("language"), F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("slug"))
    return nodes, items


@query()
def extract_simple(spark, d):
    nodes, items = _pricing_nodes(spark, d)
    payloads, errors = extract.extract_simple(nodes, items)
    kept = payloads.select("item_id", F.to_json("payload").alias("payload"), F.lit(None).cast("string").alias("error"))
    return kept.unionByName(errors.select("item_id", F.lit(None).cast("string").alias("payload"), "error"))


@query()
def project_regions(spark, d):
    """Selector bodies for each region; the region's row names one of two table units, or none."""
    nodes, _ = _pricing_nodes(spark, d)
    bodies = nodes.where((F.col("tag") == "div") & tree.has_class("technical-azure-selector")).select("item_id", "pre", "last")
    regions = spark.read.parquet(f"{d}/region.parquet")
    named = F.when(F.col("r_name").startswith("A"), F.array(F.lit("t1"))).when(F.col("r_name").startswith("E"), F.array(F.lit("t1"), F.lit("t2"))).otherwise(F.array().cast("array<string>"))
    lookups = bodies.select("item_id").crossJoin(F.broadcast(regions.select(F.col("r_name").alias("region"), named.alias("table_ids"))))
    return extract.project_regions(nodes, bodies, lookups)


@query(r"SELECT CAST(page_id AS BIGINT) AS item_id, t AS table_id, 1 AS units FROM pages, (VALUES ('t1'), ('t2')) v(t)")
def table_unit_canonical(spark, d):
    nodes, _ = _pricing_nodes(spark, d)
    units = extract.table_units(nodes)
    tags = nodes.select("item_id", F.col("pre").alias("unit"), "tag", "classes")
    return units.join(tags, ["item_id", "unit"]).where((F.col("table_id") == "t1") & (F.col("tag") == "div") | (F.col("table_id") == "t2") & (F.col("tag") == "table")).groupBy("item_id", "table_id").agg(F.count("*").cast("int").alias("units"))


@query()
def support_article_split(spark, d):
    nodes = staged(shred(spark.read.parquet(f"{d}/pages.parquet").withColumn("html", F.replace("html", F.lit("<footer>"), F.lit("<h2>Footer</h2><footer>")))), "nodes")[0]
    return extract.extract_support(nodes, nodes.select("item_id").distinct())


@query("""SELECT c_custkey AS item_id, r AS rule FROM customer, LATERAL (SELECT unnest(list_filter([CASE WHEN c_acctbal < 0 THEN 'R05 slug' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'R06 language' END, CASE WHEN c_nationkey > 20 THEN 'R20 group order' END, CASE WHEN c_acctbal > 9000 THEN 'R35 page type' END, CASE WHEN c_custkey < 20 THEN 'R44 default' END], lambda x: x IS NOT NULL)) AS r)""")
def contract_violations(spark, d):
    """Payloads made of customers, some of them broken in known ways, against all rules."""
    c = spark.read.parquet(f"{d}/customer.parquet")
    option = F.struct(F.lit("north").alias("value"), F.lit("North").alias("label"), F.lit("#north").alias("href"), F.lit(True).alias("isActive"), F.when(F.col("c_custkey") >= 20, F.lit(True)).alias("isDefault"))
    filters = F.to_json(F.struct(F.array(F.struct(F.lit("region").alias("filterKey"), F.lit("dropdown").alias("filterType"), F.lit("Region").alias("displayName"), F.array(option).alias("options"))).alias("filterDefinitions")))
    group = F.struct(F.lit("North").alias("groupName"), F.lit('[{"filterKey":"region","matchValues":"north"}]').alias("filterCriteriaJson"), F.col("c_name").alias("content"), F.when(F.col("c_nationkey") > 20, 7).otherwise(1).alias("sortOrder"), F.lit(True).alias("isActive"), F.lit(None).cast("string").alias("sharedContent"))
    section = F.struct(F.lit("Banner").alias("sectionType"), F.lit("Banner").alias("sectionTitle"), F.col("c_mktsegment").alias("content"), F.lit(1).alias("sortOrder"), F.lit(True).alias("isActive"))
    config = F.struct(F.col("c_name").alias("displayTitle"), F.lit(contract.PAGE_ICON).alias("pageIcon"), F.lit("nav").alias("leftNavigationIdentifier"), F.when(F.col("c_acctbal") > 9000, "Simple").otherwise("RegionFilter").alias("pageType"), F.lit(True).alias("enableFilters"), filters.alias("filtersJsonConfig"))
    payload = F.struct(F.col("c_name").alias("title"), F.lit("").alias("metaTitle"), F.lit("").alias("metaDescription"), F.lit("").alias("metaKeywords"), F.when(F.col("c_acctbal") < 0, "wrong").otherwise("key").alias("slug"), F.when(F.col("c_mktsegment") == "BUILDING", "en-us").otherwise("zh-cn").alias("language"), F.lit("").alias("baseContent"), F.array(group).alias("contentGroups"), F.array(section).alias("commonSections"), config.alias("pageConfig"))
    items, _ = staged(c.select(F.col("c_custkey").alias("item_id"), payload.alias("payload")), "payloads")
    return contract.violations(items, contract.pricing_rules(F.col("payload"), F.lit("region_filter"), F.lit("key"), F.lit("zh-cn")))


@query("""SELECT o_orderkey, path, difference FROM orders, LATERAL (SELECT unnest(list_filter([CASE WHEN o_totalprice > 300000 THEN {'path': '$.status', 'difference': 'value'} END, CASE WHEN o_orderstatus = 'P' THEN {'path': '$.tags', 'difference': 'length'} END, CASE WHEN o_orderstatus = 'P' THEN {'path': '$.tags[1]', 'difference': 'extra'} END], lambda x: x IS NOT NULL), recursive := true))""")
def l3a_tree_diff(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    text = lambda status, tags: F.to_json(F.struct(status.alias("status"), F.col("o_orderkey").alias("id"), tags.alias("tags")))
    first = F.array("o_orderpriority")
    old = o.select("o_orderkey", text(F.col("o_orderstatus"), first).alias("json"))
    new = o.select("o_orderkey", text(F.when(F.col("o_totalprice") > 300000, F.lit("changed")).otherwise(F.col("o_orderstatus")), F.when(F.col("o_orderstatus") == "P", F.array("o_orderpriority", F.lit("more"))).otherwise(first)).alias("json"))
    return verify.text_difference(old, new, "o_orderkey", "json")


_VERSIONS = """(SELECT l_orderkey AS k, l_linenumber AS n, min(l_returnflag) AS flag, min(l_linestatus) AS state, min(l_quantity) AS q FROM lineitem GROUP BY 1, 2)"""


@query(f"""SELECT k, CAST(n AS BIGINT) AS n, 'flag' AS field, CASE WHEN n = 7 THEN 'missing' WHEN q > 45 THEN 'mismatched' ELSE 'matched' END AS status FROM {_VERSIONS} UNION ALL SELECT k, CAST(n AS BIGINT), 'state', CASE WHEN n = 7 THEN 'missing' ELSE 'matched' END FROM {_VERSIONS}""")
def l3b_field_compare(spark, d):
    expected, actual = _versions(spark, d)
    return verify.field_comparison(expected, actual, ["k", "n"], ["flag", "state"])


@query(f"SELECT 'flag' AS field, count(*) FILTER (n != 7 AND q <= 45) AS matched, count(*) FILTER (n = 7 OR q > 45) AS mismatched FROM {_VERSIONS} UNION ALL SELECT 'state', count(*) FILTER (n != 7), count(*) FILTER (n = 7) FROM {_VERSIONS}")
def workbench_summary(spark, d):
    expected, actual = _versions(spark, d)
    return verify.comparison_summary(verify.field_comparison(expected, actual, ["k", "n"], ["flag", "state"]))


def _versions(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    expected = lines.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("n")).agg(F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("state"), F.min("l_quantity").alias("q"))
    return expected, expected.where("n != 7").withColumn("flag", F.when(F.col("q") > 45, F.lit("?")).otherwise(F.col("flag")))


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    return _windows(spark.read.parquet(f"{d}/events.parquet"))


@query("""SELECT CAST(page_id AS BIGINT) AS item_id, CASE WHEN page_id % 10 < 3 THEN 'blocked' ELSE 'passed' END AS status, CASE WHEN page_id % 10 = 0 THEN 'input' WHEN page_id % 10 < 3 THEN 'extraction' ELSE '' END AS reason FROM pages""")
def batch_of_simple_pages(spark, d):
    """A batch from pages to accounts: some pages are missing, some have no body, some break the contract."""
    return run_simple(*_simple_scope(spark, d)).items.select("item_id", "status", "reason")


def _simple_scope(spark, d):
    pages = _pricing_pages(spark, d).withColumnRenamed("page_id", "item_id")
    digit = F.col("item_id") % 10
    html = F.when(digit == 1, F.replace("html", F.lit("technical-azure-selector"), F.lit("other"))).when(digit == 2, F.regexp_replace("html", "<title>[^<]*</title>", "<title> </title>")).otherwise(F.col("html"))
    items = pages.select("item_id", F.concat(F.lit("p"), F.col("item_id").cast("string")).alias("product_key"), F.lit("en-us").alias("language"), F.concat(F.lit("page-"), F.col("item_id").cast("string")).alias("slug"))
    return items, pages.where(digit != 0).select("item_id", html.alias("html"))


class _Killed(Exception):
    """What stands for the loss of the driver between two stages."""


@query("""SELECT item_id, status, reason, attempts FROM (SELECT CAST(page_id AS BIGINT) AS item_id, CASE WHEN page_id % 10 < 3 THEN 'blocked' ELSE 'passed' END AS status, CASE WHEN page_id % 10 = 0 THEN 'input' WHEN page_id % 10 < 3 THEN 'extraction' ELSE '' END AS reason FROM pages),
(SELECT 'nodes+extraction+nodes_again|extraction_again+violations+l3a+l3b|items+summary|' AS attempts)""")
def resumed_run(spark, d):
    """The same batch, killed twice between stages and taken up again, then read once more when it is sealed; ``attempts`` lists the
    stages that each attempt computed."""
    items, pages = _simple_scope(spark, d)
    path, attempts = shared_path(spark, "run"), []
    for last in ("nodes_again", "l3b", None, None):
        seen = []

        def after(name, last=last, seen=seen):
            seen.append(name)
            if name == last:
                raise _Killed(name)

        try:
            result, stages = run_or_resume(path, items, pages, "simple_static", after=after)
            attempts.append(stages.computed)
        except _Killed:
            done = {name for attempt in attempts for name in attempt}
            attempts.append([name for name in seen if name not in done])
    return result.items.select("item_id", "status", "reason", F.lit("|".join("+".join(a) for a in attempts)).alias("attempts"))
