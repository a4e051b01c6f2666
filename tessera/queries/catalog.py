"""Scope, selection and key gates over part, orders, lineitem and customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.operators import selection

from .register import registrar

QUERIES, ORACLES, query = registrar()


def _parts(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("p-"), F.col("p_partkey").cast("string")).alias("product_key"), F.col("p_partkey").alias("p_ord"), "p_brand", "p_type", "p_size", "p_name", "p_retailprice", "p_partkey")


_ITEM = "item_id, product_key, language, p_ord, CAST(l_ord AS BIGINT) AS l_ord"
_PARTS = "(SELECT 'p-' || p_partkey AS product_key, p_partkey AS p_ord, * FROM part)"
_LANGS = "(VALUES ('zh-cn', 0), ('en-us', 1)) l(language, l_ord)"


@query(f"SELECT product_key || '/' || language AS item_id, product_key, language, p_ord, CAST(l_ord AS BIGINT) AS l_ord FROM {_PARTS}, {_LANGS}")
def scope_all_cross(spark, d):
    return selection.plan_items(_parts(spark, d).select("product_key", "p_ord"), selection.language_table(spark)).selectExpr(*_ITEM.split(", "))


@query(f"SELECT lower(trim(p_brand)) AS category, product_key || '/' || language AS item_id, p_ord, CAST(l_ord AS BIGINT) AS l_ord FROM {_PARTS}, {_LANGS}")
def scope_category(spark, d):
    chosen = _parts(spark, d).withColumn("category", F.lower(F.trim("p_brand"))).select("category", "product_key", "p_ord")
    return selection.plan_items(chosen, selection.language_table(spark)).selectExpr("category", "item_id", "p_ord", "cast(l_ord as bigint) as l_ord")


@query(f"SELECT p.product_key || '/' || language AS item_id, w.p_ord, CAST(l_ord AS BIGINT) AS l_ord FROM {_PARTS} p JOIN (SELECT l_partkey, min(l_orderkey * 100 + l_linenumber) AS p_ord FROM lineitem GROUP BY 1) w ON p.p_partkey = w.l_partkey, {_LANGS}")
def scope_list_ordered(spark, d):
    """A list of products keeps its own order: here that of first appearance in lineitem."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    wanted = lines.groupBy(F.concat(F.lit("p-"), F.col("l_partkey").cast("string")).alias("product_key")).agg(F.min(F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("p_ord"))
    chosen = selection.select_list(_parts(spark, d).select("product_key"), wanted)
    return selection.plan_items(chosen, selection.language_table(spark)).selectExpr("item_id", "p_ord", "cast(l_ord as bigint) as l_ord")


@query("SELECT lower(trim(c_mktsegment)) AS category, count(DISTINCT c_custkey) AS products FROM customer GROUP BY 1")
def available_categories(spark, d):
    return selection.available_categories(spark.read.parquet(f"{d}/customer.parquet"), "c_custkey", "c_mktsegment")


_STRATEGY = "CASE WHEN p_size < 12 THEN 'simple_static' WHEN p_size < 25 THEN 'region_filter' WHEN p_size < 40 THEN 'complex' ELSE 'support_article' END"


@query(f"""SELECT p.product_key, CASE WHEN o.k IS NOT NULL AND s != 'support_article' THEN 'complex' ELSE s END AS strategy, o.k IS NOT NULL AND s != 'support_article' AS overridden
FROM (SELECT *, {_STRATEGY} AS s FROM {_PARTS}) p LEFT JOIN (SELECT l_partkey AS k FROM lineitem GROUP BY 1 HAVING max(l_returnflag) = 'R' AND max(l_discount) > 0.05) o ON o.k = p.p_partkey""")
def strategy_override(spark, d):
    products = _parts(spark, d).select("product_key", F.expr(_STRATEGY).alias("strategy"))
    lines = spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_partkey").agg(F.max("l_returnflag").alias("flag"), F.max("l_discount").alias("off"))
    overrides = lines.select(F.concat(F.lit("p-"), F.col("l_partkey").cast("string")).alias("product_key"), F.lit("complex").alias("strategy"), F.when((F.col("flag") == "R") & (F.col("off") > 0.05), F.lit("returned")).otherwise(F.lit(" ")).alias("reason"))
    return selection.apply_overrides(products, overrides).select("product_key", "strategy", "overridden")


@query(f"""SELECT product_key, s AS strategy, CASE s WHEN 'simple_static' THEN p_name WHEN 'region_filter' THEN p_brand WHEN 'complex' THEN p_brand || ' - ' || p_type END AS out,
CASE WHEN s = 'support_article' THEN 'unknown strategy: support_article' END AS error FROM (SELECT *, {_STRATEGY} AS s FROM {_PARTS})""")
def strategy_dispatch(spark, d):
    rows = _parts(spark, d).withColumn("strategy", F.expr(_STRATEGY))
    branches = {"simple_static": F.col("p_name"), "region_filter": F.col("p_brand"), "complex": scalars.group_name(F.array("p_brand", "p_type"))}
    return selection.dispatch(rows, "strategy", branches, "out").select("product_key", "strategy", "out", "error")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return selection.duplicate_keys(spark.read.parquet(f"{d}/orders.parquet"), "o_custkey")


@query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def unknown_keys(spark, d):
    known = spark.read.parquet(f"{d}/orders.parquet").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return selection.unknown_keys(spark.read.parquet(f"{d}/customer.parquet"), known, "c_custkey")


@query("SELECT c_custkey, k AS product_key, regexp_full_match(k, '[a-z0-9]+(-[a-z0-9]+)*') AS readable FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name ELSE replace(lower(c_name), '#', '-') END AS k FROM customer)")
def id_format_filter(spark, d):
    keyed = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(F.replace(F.lower("c_name"), F.lit("#"), F.lit("-"))).alias("product_key"))
    return keyed.withColumn("readable", scalars.is_readable_id(F.col("product_key")))


@query(r"SELECT page_id, p AS path, p != '' AND NOT regexp_matches(p, '^/|(^|/)\.\.(/|$)|\\|//') AS safe FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS p FROM pages UNION ALL SELECT page_id, regexp_replace(url, '^[a-z]+://[^/]*', '..') FROM pages)")
def path_safety_filter(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet")
    paths = pages.select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("path")).unionByName(pages.select("page_id", F.regexp_replace("url", "^[a-z]+://[^/]*", "..").alias("path")))
    return paths.withColumn("safe", scalars.is_safe_path(F.col("path")))


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = (SELECT count(DISTINCT o_orderpriority) FROM orders)")
def complete_groups(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_custkey", "o_orderpriority")
    return selection.complete_groups(orders, "o_custkey", "o_orderpriority", orders)


@query("""SELECT c.o_custkey, CASE WHEN o.n = 1 THEN o.k END AS o_orderkey, coalesce(o.n, 0) AS matches, CASE WHEN coalesce(o.n, 0) != 1 THEN 'matches: ' || coalesce(o.n, 0) END AS error
FROM (SELECT c_custkey AS o_custkey FROM customer) c LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) o USING (o_custkey)""")
def option_strict_join(spark, d):
    from tessera.operators.controls import strict_match

    orders = spark.read.parquet(f"{d}/orders.parquet").where("o_orderstatus = 'O'").select("o_custkey", "o_orderkey")
    return strict_match(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("o_custkey")), orders, ["o_custkey"], "o_orderkey")
