"""Runs: customers are runs or products, their orders the items, their lines what a run has recorded."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import chains, runs
from tessera.plans import independent
from tessera.sources import listing
from tessera.sources.commit import shared_path

from .register import registrar

QUERIES, ORACLES, query = registrar()


def _table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


_PLAN = """(SELECT CAST(o_orderkey AS VARCHAR) AS item_id, o_custkey AS product_key, lower(o_orderstatus) AS language, CASE WHEN o_orderpriority LIKE '1%' THEN 'support' ELSE 'pricing' END AS family,
 CASE WHEN o_totalprice < 400000 THEN 'SLA' END AS article_type, CASE WHEN o_totalprice > 300000 THEN 'complex' WHEN o_totalprice > 200000 THEN 'region_filter' ELSE 'simple_static' END AS strategy, CASE WHEN o_totalprice > 350000 THEN 'after' END AS boundary FROM orders)"""
_FROZEN = "CASE WHEN family = 'pricing' THEN language || '/pricing/' || product_key || '.html' WHEN article_type IS NOT NULL THEN language || '/support-articles/' || article_type || '/' || product_key || '.html' END"


def _plan(spark, d):
    price = F.col("o_totalprice")
    return _table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("item_id"),
        F.col("o_custkey").alias("product_key"),
        F.lower("o_orderstatus").alias("language"),
        F.when(F.col("o_orderpriority").startswith("1"), "support").otherwise("pricing").alias("family"),
        F.when(price < 400000, "SLA").alias("article_type"),
        F.when(price > 300000, "complex").when(price > 200000, "region_filter").otherwise("simple_static").alias("strategy"),
        F.when(price > 350000, "after").alias("boundary"),
    )


@query(f"""SELECT item_id, 'pending' AS status, 'pending' AS l3b, f AS frozen_path, 'runs/' || product_key || '/payload/' || regexp_replace(f, '\\.html$', '.json') AS payload_path,
 CASE WHEN f IS NULL THEN 'runs/' || product_key || '/l3a' ELSE 'runs/' || product_key || '/l3a/' || regexp_replace(f, '\\.html$', '.json') END AS l3a_path FROM (SELECT *, {_FROZEN} AS f FROM {_PLAN}) WHERE f IS NOT NULL""")
def manifest_skeleton(spark, d):
    plan = _plan(spark, d).withColumn("frozen_path", runs.frozen_path()).where("frozen_path is not null")
    return runs.manifest_items(plan, F.col("product_key")).select("item_id", "status", "l3b", "frozen_path", "payload_path", "l3a_path")


@query(f"SELECT item_id, strategy AS effective_strategy, boundary IS NOT NULL AS has_boundary, CASE WHEN strategy != 'simple_static' THEN 'configs/soft-category.json' END AS soft_category_path FROM {_PLAN}")
def strategy_configs(spark, d):
    return runs.strategy_config(_plan(spark, d), "configs/soft-category.json").select("item_id", "effective_strategy", "has_boundary", "soft_category_path")


@query("""SELECT c_custkey AS form, CASE WHEN c_nationkey = 0 THEN 'product' WHEN c_nationkey < 5 THEN 'products' WHEN c_nationkey < 15 THEN 'category' WHEN c_acctbal > 0 THEN 'all' END AS kind,
 CASE WHEN c_nationkey = 0 THEN c_name WHEN c_nationkey BETWEEN 5 AND 14 THEN lower(c_mktsegment) END AS value, CASE WHEN c_nationkey >= 15 AND c_acctbal <= 0 THEN 'nothing selected' END AS error FROM customer""")
def selection_descriptions(spark, d):
    n = F.col("c_nationkey")
    forms = _table(spark, d, "customer").select(F.col("c_custkey").alias("form"), F.when(n == 0, F.col("c_name")).alias("product_key"), F.when(n < 5, F.array("c_name")).alias("product_keys"), F.when(n < 15, F.concat(F.lit(" "), F.upper("c_mktsegment"), F.lit(" "))).alias("category"), (F.col("c_acctbal") > 0).alias("all_products"))
    return runs.selection_description(forms).select("form", "kind", "value", "error")


@query("SELECT p_partkey AS path, CASE WHEN p_size > 40 THEN 'copy' WHEN p_size < 4 THEN 'blocked' ELSE 'confirm' END AS action FROM part")
def copy_or_confirm(spark, d):
    parts = _table(spark, d, "part").select(F.col("p_partkey").alias("path"), F.col("p_name").alias("content"), "p_size")
    there = parts.where("p_size <= 40").withColumn("content", F.when(F.col("p_size") < 4, F.lit("old")).otherwise(F.col("content")))
    return runs.copy_or_confirm(parts, there, "path", "content")


@query("""SELECT p_partkey AS path, CASE WHEN p_size <= 40 AND p_size != 20 AND p_size != 21 THEN p_size < 4 END AS differs, CASE WHEN p_size > 40 THEN 'missing' WHEN p_size = 20 THEN 'previous changed while read' WHEN p_size = 21 THEN 'current changed while read' END AS error FROM part""")
def file_differences(spark, d):
    parts = _table(spark, d, "part").select(F.col("p_partkey").alias("path"), F.col("p_name").alias("content"), "p_size", F.col("p_partkey").alias("state"))
    moved = lambda size: F.when(F.col("p_size") == size, F.col("state") + 1).otherwise(F.col("state")).alias("state_after")
    previous = parts.select("*", moved(20))
    current = parts.where("p_size <= 40").select("path", F.when(F.col("p_size") < 4, F.lit("old")).otherwise(F.col("content")).alias("content"), "state", moved(21))
    return runs.file_differences(previous, current, "path", "content", "state")


@query("""SELECT 'run-' || o_custkey AS run, CASE WHEN o_custkey % 7 = 0 THEN 'not sealed' WHEN o_custkey % 7 = 1 THEN 'name differs' WHEN count(*) FILTER (o_orderstatus = 'P') > 0 THEN 'items pending' END AS error FROM orders GROUP BY o_custkey""")
def sealed_runs(spark, d):
    name = F.concat(F.lit("run-"), F.col("o_custkey").cast("string"))
    k = F.col("o_custkey") % 7
    rows = _table(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "P").alias("pending"))
    return runs.sealed_runs(rows.select(name.alias("run"), F.concat(name, F.when(k == 0, ".building").when(k == 1, "-old").otherwise("")).alias("directory"), "pending"))


@query(f"""SELECT item_id, CASE WHEN o_orderkey % 11 = 0 THEN 'missing' WHEN o_orderkey % 11 = 1 THEN 'check differs' WHEN o_orderkey % 11 = 2 THEN 'product differs' WHEN o_orderkey % 11 = 3 THEN 'language differs' WHEN o_totalprice < 30000 THEN 'not passed' END AS error FROM {_PLAN} JOIN orders ON item_id = CAST(o_orderkey AS VARCHAR)""")
def passed_checks(spark, d):
    k = F.col("o_orderkey") % 11
    reports = _table(spark, d, "orders").where(k != 0).select(F.col("o_orderkey").cast("string").alias("item_id"), F.when(k == 1, "l3b").otherwise("l3a").alias("check"), (F.col("o_custkey") + F.when(k == 2, 1).otherwise(0)).alias("product_key"), F.when(k == 3, "?").otherwise(F.lower("o_orderstatus")).alias("language"), F.when(F.col("o_totalprice") < 30000, "failed").otherwise("passed").alias("status"))
    return runs.passed_checks(reports, _plan(spark, d), "l3a")


@query("SELECT o_custkey AS run, o_orderkey AS product_key, CASE WHEN o_orderstatus = 'P' THEN 'no decision' WHEN o_orderkey % 5 = 0 THEN 'name differs' END AS error FROM orders")
def closed_products(spark, d):
    decisions = _table(spark, d, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("product_key"), F.when(F.col("o_orderstatus") != "P", "ended_without_delivery").alias("decision"), F.concat(F.lit("closures/"), F.col("o_custkey").cast("string"), F.lit("/"), F.when(F.col("o_orderkey") % 5 == 0, "other").otherwise(F.col("o_orderkey").cast("string")), F.lit(".json")).alias("path"))
    return runs.closed_products(decisions)


_RUN_ITEMS = "(SELECT DISTINCT l_orderkey AS run, l_partkey AS product_key, l_linestatus AS s, l_returnflag AS f, l_quantity AS q FROM lineitem)"
_BATCHES = f"""(SELECT run, count(DISTINCT product_key) FILTER (a) AS affected, count(DISTINCT product_key) FILTER (a AND dd) AS delivered, count(DISTINCT product_key) FILTER (a AND NOT dd AND c) AS closed, count(DISTINCT product_key) FILTER (a AND NOT dd AND NOT c) AS unresolved, count(DISTINCT product_key) FILTER (NOT a) AS unknown
 FROM (SELECT run, product_key, bool_or(q > 1) AS a, bool_or(s = 'F') AS dd, bool_or(f = 'N' AND q > 10 OR q <= 1) AS c FROM {_RUN_ITEMS} GROUP BY 1, 2 HAVING bool_or(q > 1) OR bool_or(s = 'F') OR bool_or(f = 'N' AND q > 10 OR q <= 1)) GROUP BY run)"""


def _batches(spark, d):
    lines = _table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run"), F.col("l_partkey").alias("product_key"), "l_linestatus", "l_returnflag", "l_quantity")
    return lines.where("l_quantity > 1"), lines.where("l_linestatus = 'F'"), lines.where("l_returnflag = 'N' and l_quantity > 10 or l_quantity <= 1")


@query(f"SELECT run, affected, delivered, closed, unresolved, CASE WHEN unknown > 0 THEN 'ends outside the scope' WHEN unresolved > 0 AND (SELECT count(*) FROM {_BATCHES} WHERE unresolved > 0) > 1 THEN 'several open batches' END AS error FROM {_BATCHES}")
def open_batches(spark, d):
    return runs.open_batches(*_batches(spark, d))


@query(f"""SELECT l_orderkey AS run, l_partkey AS product_key, CASE WHEN l_tax = 0 THEN 'no reviewer' WHEN l_discount = 0 THEN 'no reason' WHEN b.run IS NULL THEN 'no open batch' WHEN l_orderkey % 3 = 0 THEN 'not sealed' WHEN u.run IS NULL THEN 'not unresolved' END AS error
 FROM lineitem LEFT JOIN (SELECT run FROM {_BATCHES} WHERE unresolved > 0) b ON b.run = l_orderkey LEFT JOIN (SELECT run, product_key FROM {_RUN_ITEMS} GROUP BY 1, 2 HAVING bool_or(q > 1) AND NOT bool_or(s = 'F') AND NOT bool_or(f = 'N' AND q > 10 OR q <= 1)) u ON u.run = l_orderkey AND u.product_key = l_partkey""")
def end_without_delivery(spark, d):
    affected, delivered, closed = _batches(spark, d)
    key = ["run", "product_key"]
    left = affected.select(*key).join(delivered.select(*key), key, "left_anti").join(closed.select(*key), key, "left_anti")
    lines = _table(spark, d, "lineitem")
    requests = lines.select(F.col("l_orderkey").alias("run"), F.col("l_partkey").alias("product_key"), F.when(F.col("l_tax") == 0, " ").otherwise("r").alias("reviewer"), F.when(F.col("l_discount") == 0, "").otherwise("why").alias("reason"))
    return runs.end_without_delivery(requests, runs.open_batches(affected, delivered, closed).withColumn("sealed", F.col("run") % 3 != 0), left)


def _roots(spark, d):
    return chains.chain_depths(chains.linear_chains(_table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey"))


_ROOTS = "(SELECT o_orderkey AS record, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS root FROM orders)"


@query(f"SELECT r.record, i.name, i.content, CASE WHEN i.name IS NULL THEN 'no fixed inputs' END AS error FROM {_ROOTS} r LEFT JOIN (SELECT l_orderkey AS run, l_linenumber AS name, l_returnflag AS content FROM lineitem WHERE l_quantity > 20) i ON i.run = r.root")
def inherited_inputs(spark, d):
    """Every record of a chain reads the inputs that its first one has fixed."""
    lines = _table(spark, d, "lineitem").where("l_quantity > 20").select(F.col("l_orderkey").alias("from"), F.col("l_linenumber").alias("name"), F.col("l_returnflag").alias("content"))
    return runs.inherited_inputs(_roots(spark, d), runs.fixed_inputs(lines, F.col("from")).drop("from"))


@query(f"SELECT record, CASE WHEN root % 4 != 0 THEN root END AS run, CASE WHEN root % 4 = 0 THEN 'unknown run' END AS error FROM {_ROOTS}")
def parent_runs(spark, d):
    return runs.parent_runs(_roots(spark, d), _table(spark, d, "orders").where("o_orderkey % 4 != 0").select(F.col("o_orderkey").alias("run")))


@query("""WITH r AS (SELECT o_orderkey AS record, lag(o_orderkey) OVER w AS up, lead(o_orderkey) OVER w AS down, last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS tail, count(*) OVER (PARTITION BY o_custkey) AS n, o_custkey AS c FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT record, 'circle' AS error FROM r WHERE c % 10 = 0""")
def chain_circles(spark, d):
    """Chains of some customers are closed to circles."""
    orders = _table(spark, d, "orders")
    records = chains.linear_chains(orders, "o_custkey", "o_orderdate", "o_orderkey").join(orders.select(F.col("o_orderkey").alias("record"), "o_custkey"), "record")
    tails = orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("tail"))
    closed = records.join(tails, "o_custkey").select("record", F.when((F.col("o_custkey") % 10 == 0) & F.col("parent").isNull(), F.col("tail")).otherwise(F.col("parent")).alias("parent"))
    return chains.chain_circles(closed)


@query(f"""SELECT item_id, CASE WHEN k % 13 = 0 THEN 'missing' WHEN k % 13 = 1 THEN 'added' WHEN k % 13 = 2 AND boundary IS NOT NULL THEN 'strategy,boundary' WHEN k % 13 = 2 THEN 'strategy' WHEN k % 13 = 3 THEN 'order differs' END AS error FROM (SELECT *, CAST(item_id AS BIGINT) AS k FROM {_PLAN})""")
def reprocess_eligibility(spark, d):
    plan = _plan(spark, d).withColumn("ordinal", F.col("item_id").cast("bigint"))
    k = F.col("ordinal") % 13
    now = plan.where(k != 0).withColumns({"strategy": F.when(k == 2, "other").otherwise(F.col("strategy")), "boundary": F.when(k != 2, F.col("boundary"))}).withColumn("ordinal", F.col("ordinal") + F.when(k == 3, 1).otherwise(0))
    return runs.plan_differences(plan.where(k != 1), now, ("product_key", "language", "strategy", "boundary"))


@query("SELECT p_partkey AS product_key, CASE WHEN p_size < 10 THEN 'was' ELSE p_brand END AS definition FROM part")
def acknowledged_baseline(spark, d):
    parts = _table(spark, d, "part").withColumnRenamed("p_partkey", "product_key")
    return runs.acknowledge(parts.select("product_key", F.lit("was").alias("definition")), parts.select("product_key", F.col("p_brand").alias("definition")), parts.where("p_size < 10"))


def _page_items(spark, d):
    pages = _table(spark, d, "pages")
    return pages, pages.select(F.col("page_id").alias("item_id"), F.when(F.col("page_id") % 4 == 0, "blocked").otherwise("passed").alias("input"))


@query("SELECT CAST(page_id AS BIGINT) AS item_id, CASE WHEN page_id % 5 = 0 OR page_id % 7 = 0 THEN 'input changed' END AS error FROM pages WHERE page_id % 4 != 0")
def resume_inputs(spark, d):
    """Whole pages that are frozen against whole pages upstream."""
    pages, items = _page_items(spark, d)
    source = pages.where("page_id % 5 != 0").select(F.col("page_id").alias("item_id"), F.col("html").alias("content"))
    frozen = pages.select(F.col("page_id").alias("item_id"), F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html")).alias("content"))
    return runs.resume_inputs(items, source, frozen)


@query("SELECT CAST(page_id AS BIGINT) AS item_id, CASE WHEN page_id % 5 = 0 THEN 'run' WHEN page_id % 7 = 0 THEN 'blocked' ELSE 'reuse' END AS action FROM pages")
def resume_results(spark, d):
    pages, items = _page_items(spark, d)
    fresh = pages.select(F.col("page_id").alias("item_id"), F.col("html").alias("content"))
    stored = fresh.where("item_id % 5 != 0").withColumn("content", F.when(F.col("item_id") % 7 == 0, F.lit("other")).otherwise(F.col("content")))
    return runs.resume_results(items, stored, fresh)


@query("""SELECT item_id, CASE WHEN k % 9 = 0 THEN 'identity differs' WHEN NOT uses THEN 'lookups of no consumer' WHEN n > dn THEN 'lookup repeated' WHEN absent THEN 'ids without a row' END AS error FROM
 (SELECT CASE WHEN l_orderkey % 9 = 0 THEN 'x' ELSE l_orderkey || '/p' END AS item_id, l_orderkey AS k, max(l_linenumber) < 7 AS uses, count(*) AS n, count(DISTINCT l_returnflag || ' ' || l_suppkey) AS dn, bool_or(l_quantity < 2) AS absent FROM lineitem GROUP BY l_orderkey)""")
def usage_reports(spark, d):
    lookup = F.struct(F.col("l_returnflag").alias("os"), F.col("l_suppkey").cast("string").alias("region"), (F.col("l_quantity") >= 2).alias("row_present"), F.array(F.lit("t")).alias("table_ids"))
    rows = _table(spark, d, "lineitem").groupBy("l_orderkey").agg((F.max("l_linenumber") < 7).alias("uses"), F.collect_list(lookup).alias("lookups"))
    key = F.col("l_orderkey").cast("string")
    return runs.usage_report_errors(rows.select(F.when(F.col("l_orderkey") % 9 == 0, "x").otherwise(F.concat(key, F.lit("/p"))).alias("item_id"), key.alias("product_key"), F.lit("p").alias("language"), "uses", "lookups"))


@query("""SELECT o_custkey AS product_key, CASE WHEN n = 3 AND lo = hi THEN lo END AS page_model, CASE WHEN n != 3 THEN 'language missing' WHEN lo != hi THEN 'items differ' END AS error FROM (SELECT o_custkey, count(DISTINCT o_orderstatus) AS n, min(m) AS lo, max(m) AS hi FROM (SELECT *, CASE WHEN o_totalprice > 250000 THEN 'support' ELSE 'flexible' END AS m FROM orders) GROUP BY 1)""")
def manifest_baseline(spark, d):
    items = _table(spark, d, "orders").select(F.col("o_custkey").alias("product_key"), F.col("o_orderstatus").alias("language"), F.when(F.col("o_totalprice") > 250000, "support").otherwise("flexible").alias("page_model"))
    return runs.baseline_from_manifest(items, ("page_model",), 3)


@query("""SELECT count(*) AS selected, count(*) FILTER (a != 'blocked') AS passed, count(*) FILTER (a = 'blocked') AS blocked, count(*) FILTER (a = 'copied') AS copied, count(*) FILTER (a = 'updated') AS updated, count(*) FILTER (a = 'unchanged') AS unchanged
 FROM (SELECT CASE WHEN NOT bool_and(o_totalprice >= 1500) OVER (PARTITION BY o_custkey) THEN 'blocked' WHEN o_orderstatus = 'P' THEN 'copied' WHEN o_totalprice > 100000 THEN 'unchanged' ELSE 'updated' END AS a FROM orders)""")
def freeze_summary(spark, d):
    from .review import freeze_action

    return runs.freeze_summary(freeze_action(spark, d))


@query("SELECT l_orderkey AS item_id, count(*) FILTER (l_linestatus = 'O') + count(*) FILTER (l_returnflag = 'N') AS total FROM lineitem WHERE l_linestatus = 'O' OR l_returnflag = 'N' GROUP BY 1")
def interactive_total(spark, d):
    lines = _table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "item_id")
    return runs.interactive_total(lines.where("l_linestatus = 'O'"), lines.where("l_returnflag = 'N'"))


@query(r"""SELECT c_custkey AS product_key, '# ' || c_name || ' (' || c_custkey || ')' || chr(10) || chr(10) || '- page model: ' || c_mktsegment || chr(10) || '- strategy: s' || chr(10) || '- languages: ' || count(*) || ' of 3' || chr(10) || chr(10) || '| language | frozen_html | payload | l3a | l3b |' || chr(10) || '|---|---|---|---|---|' || chr(10) ||
 string_agg('| ' || l || ' | [open](<../' || l || '/h>) | [open](<../' || l || '/p>) | [open](<../' || l || '/a>) | [open](<../' || l || '/b>) |', chr(10) ORDER BY list_position(['O', 'F', 'P'], l)) AS markdown FROM (SELECT DISTINCT c_custkey, c_name, c_mktsegment, o_orderstatus AS l FROM customer JOIN orders ON o_custkey = c_custkey) GROUP BY c_custkey, c_name, c_mktsegment""")
def review_material(spark, d):
    orders = _table(spark, d, "orders").select(F.col("o_custkey").alias("product_key"), F.col("o_orderstatus").alias("language")).distinct()
    people = _table(spark, d, "customer").select(F.col("c_custkey").alias("product_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("page_model"), F.lit("s").alias("strategy"))
    paths = {f"{kind}_path": F.concat("language", F.lit(f"/{end}")) for kind, end in zip(runs.MATERIALS, "hpab", strict=True)}
    items = orders.join(people, "product_key").withColumns(paths).withColumn("product_key", F.col("product_key").cast("string"))
    return runs.material_markdown(items, ["O", "F", "P"]).select(F.col("product_key").cast("bigint").alias("product_key"), "markdown")


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS os, region, list_sort(list(DISTINCT id)) AS table_ids, CASE WHEN bool_or(id = '') THEN 'empty id' END AS error FROM
 (SELECT l_suppkey, l_returnflag AS region, CASE WHEN l_quantity = 1 THEN '' WHEN l_quantity = 2 THEN '#' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS id FROM lineitem) GROUP BY l_suppkey, region""")
def second_exclusions(spark, d):
    """The checker's own reading of exclusion rows."""
    q, key = F.col("l_quantity"), F.col("l_partkey").cast("string")
    ids = F.when(q == 1, F.lit(" # ")).when(q == 2, F.concat(F.lit("##"), key)).otherwise(F.concat(F.lit(" #"), key, F.lit(" ")))
    raw = _table(spark, d, "lineitem").groupBy(F.concat(F.lit(" "), F.col("l_suppkey").cast("string")).alias("os"), F.concat("l_returnflag", F.lit(" ")).alias("region")).agg(F.collect_list(ids).alias("ids"))
    return independent.second_exclusions(raw).select("os", "region", F.array_sort("table_ids").alias("table_ids"), "error")


@query("""WITH l AS (SELECT DISTINCT l_suppkey AS s, l_returnflag || l_linestatus AS p FROM lineitem), r AS (SELECT s_suppkey AS s, count(l.p) AS n FROM supplier LEFT JOIN l ON l.s = s_suppkey GROUP BY 1)
SELECT CASE WHEN s % 13 != 0 THEN 'run-' || s END AS run, 'run-' || s || CASE WHEN s % 7 = 0 THEN '.building' ELSE '' END || CASE WHEN s % 11 = 0 AND s % 13 != 0 THEN '-x' ELSE '' END AS directory, s % 7 != 0 OR s % 11 = 0 AND s % 13 != 0 AS sealed, CASE WHEN s % 13 != 0 THEN CASE WHEN s % 5 = 0 AND n > 0 THEN n + 1 ELSE n END END AS products, CASE WHEN s % 13 != 0 AND s % 3 = 0 THEN 1 ELSE 0 END AS pending,
CASE WHEN s % 13 = 0 THEN 'unreadable manifest' WHEN s % 11 = 0 THEN 'name differs' WHEN s % 5 = 0 AND n > 0 THEN 'product named twice' END AS error FROM r""")
def listed_runs(spark, d):
    """Manifests of a run for each supplier, written to folders and read back from them: some are being written, some stand in a folder of another
    name, some name a product twice, some can't be read."""
    s, root = F.col("s_suppkey"), shared_path(spark, "runs")
    kinds = _table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sort_array(F.collect_set(F.concat("l_returnflag", "l_linestatus"))).alias("keys"))
    rows = _table(spark, d, "supplier").join(kinds, "s_suppkey", "left").withColumn("keys", F.coalesce("keys", F.array().cast("array<string>")))
    run = F.concat(F.lit("run-"), s.cast("string"))
    keys = F.when(s % 5 == 0, F.concat("keys", F.slice("keys", 1, 1))).otherwise(F.col("keys"))
    items = F.array(F.struct(F.when(s % 3 == 0, "pending").otherwise("passed").alias("status")))
    manifest = F.to_json(F.struct(run.alias("run_name"), F.lit("incremental").alias("batch_kind"), F.struct(keys.alias("product_keys")).alias("scope"), items.alias("items")))
    place = F.concat(run, F.when(s % 7 == 0, listing.BUILDING).otherwise(""), F.when((s % 11 == 0) & (s % 13 != 0), "-x").otherwise(""))
    listing.write_manifests(rows.select(place.alias("directory"), F.when(s % 13 == 0, "{no manifest").otherwise(manifest).alias("content")), root)
    found = listing.runs_in(spark, root)
    return found.select("run", "directory", "sealed", F.size("product_keys").cast("bigint").alias("products"), "pending", "error").withColumn("products", F.when(F.col("run").isNotNull(), F.col("products")))
